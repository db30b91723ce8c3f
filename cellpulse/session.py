"""Session settings the results depend on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch on its way to Python. A batch is held by executor and worker at once, by each several times over.
ARROW_BATCH = "4m"

_local_folders: dict[str, str] = {}
_places: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_recorders: list[list[str]] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what decides results: wall-clock strings are read as UTC. Long texts go to Python in batches of bounded size."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, for checkpoints and interim tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder; on a cluster a
    machine-local folder would lose data, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        app = context.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        named = _local_folders[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named.rstrip("/") + "/checkpoints")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is written yet."""
    return f"{shared_folder(spark)}/cellpulse/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an interim table below the shared folder and read it back.

    It is computed once, survives a lost executor, and has a size on disk, by
    which the planner decides whether it may be broadcast. It stays until
    ``discard`` or ``remove`` takes it away.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    for made in _recorders:
        made.append(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _places[table] = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Remove interim tables that nothing reads any more: what was made from them has itself been written."""
    for table in tables:
        path = _places.pop(table, None) if table is not None else None
        if path is not None:
            remove(table.sparkSession, [path])


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders, wherever the session's file systems keep them."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, wherever the session's file systems keep it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders of all tables that are stored inside the block."""
    made: list[str] = []
    _recorders.append(made)
    try:
        yield made
    finally:
        _recorders.remove(made)
