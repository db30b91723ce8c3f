"""A WARC writer with dictionary compression, and its reader.

Every record is compressed on its own with a Zstandard dictionary built from
records of the same archive. The dictionary stands in a skippable frame at the
start of the archive, so an archive needs nothing else to be read, and any
record can be read alone.

A task gathers records until an archive holds ``ARCHIVE_BYTES`` of them, so
memory is bounded by that and one record. Spark writes each archive as a file
of its own wherever Spark can write: the text writer puts down the bytes as
they are, and its line end is an empty skippable frame, which readers pass
over.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with
the largest page id is the response and the others revisit it. Rows that tie on
that id are responses all. A null page id is lower than any other, and revisits
one; a null payload is empty; a null address is left out; an empty table gives
no archive and reads back as an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.llm.common import stored

MIN_REVISIT = 1000
ARCHIVE_BYTES = 6 << 20
#: Of an archive's records, so many bytes from their beginnings train its dictionary.
SAMPLE_BYTES, SAMPLE_PART, DICTIONARY_BYTES = 256 << 10, 4 << 10, 32 << 10
LEVEL = 3
SALTS = 16
DATE = "2024-01-01T00:00:00Z"

#: Fixed values of the Zstandard format: the frame that holds a dictionary, and an empty frame.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\0\0\0\0"
FRAME_MAGIC = 0xFD2FB528

READ_BACK = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def classified(pages: DataFrame) -> DataFrame:
    """``pages`` with ``html`` as bytes, ``sha1``, ``n_bytes`` and ``refers_to`` (null for a response).

    Only digests of repeated payloads meet, counted before the shuffle. The
    pages find them by digest and a salt, so copies of one page meet in many
    tasks; a small table of digests is broadcast by its size on disk instead.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), payload.alias("html")
    ).withColumns({"sha1": F.sha1("html"), "n_bytes": F.octet_length("html").cast("long")})
    repeated = (
        rows.where(F.col("n_bytes") >= MIN_REVISIT)
        .groupBy(F.col("sha1").alias("of_sha1"))
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
    )
    repeated = stored(repeated.select("of_sha1", "first"), "repeated")
    repeated = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    joined = rows.withColumn("own_salt", salt).join(
        repeated, (F.col("sha1") == F.col("of_sha1")) & (F.col("own_salt") == F.col("salt")), "left"
    )
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return joined.select("page_id", "url", "html", "sha1", "n_bytes", refers.alias("refers_to"))


def record(page_id, url, payload: bytes, sha1: str, refers_to) -> bytes:
    """A WARC record; a revisit has no payload of its own."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if url is not None:
        plain = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
        head.append(f"WARC-Target-URI: {plain}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def dictionary_of(records: list[bytes]) -> bytes:
    """A dictionary trained on parts of records evenly taken from the whole list; empty if they are too few."""
    step = max(1, len(records) * SAMPLE_PART // SAMPLE_BYTES)
    samples = [r[:SAMPLE_PART] for r in records[::step]]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # the samples have too little in common
        return b""


def archive_of(records: list[bytes]) -> bytes:
    """A dictionary in a skippable frame, then every record in a frame of its own."""
    raw = dictionary_of(records)
    known = zstandard.ZstdCompressionDict(raw) if raw else None
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True)
    head = struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
    return head + b"".join(map(compressor.compress, records))


def records_in(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    at, decompressor, view = 0, zstandard.ZstdDecompressor(), memoryview(archive)
    while at < len(archive):
        magic, size = struct.unpack_from("<I", archive, at)[0], None
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            size = struct.unpack_from("<I", archive, at + 4)[0]
            body = archive[at + 8 : at + 8 + size]
            if magic == DICTIONARY_MAGIC and size:
                decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no frame begins at byte {at}")
        end = at + frame_size(view[at:])
        yield decompressor.decompress(view[at:end])
        at = end


def frame_size(frame) -> int:
    """Bytes of the frame that begins here: its header, then blocks up to the last one."""
    at, last = zstandard.frame_header_size(frame), False
    while not last:
        head = int.from_bytes(frame[at : at + 3], "little")
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        at += 3 + (1 if kind == 1 else size)
    return at + 4 * zstandard.get_frame_parameters(frame).has_checksum


def parsed(data: bytes) -> tuple:
    """A record as a row of the result; its payload must agree with what its header says."""
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = body[: int(fields["Content-Length"])]
    length, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response":
        found, said = (len(body), hashlib.sha1(body).hexdigest()), (length, digest)
        if found != said:
            raise ValueError(f"payload {found}, header {said}")
    number = lambda urn: int(urn[10:-1]) if len(urn) > 11 else None
    refers = number(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return number(fields["WARC-Record-ID"]), length, digest, kind, refers


def write_archives(pages: DataFrame, path: str) -> None:
    """Archives of all pages, one file each, below ``path``."""

    def archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for page_id, url, html, sha1, refers in zip(
                *(batch[c] for c in ("page_id", "url", "html", "sha1", "refers_to")), strict=True
            ):
                known = lambda x: None if pd.isna(x) else int(x)
                held.append(record(known(page_id), url, bytes(html), sha1, known(refers)))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield pd.DataFrame({"archive": [archive_of(held)]})
                    held, size = [], 0
        if held:
            yield pd.DataFrame({"archive": [archive_of(held)]})

    # Long ids travel as text: pandas would turn a column with nulls into doubles.
    rows = classified(pages).withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    files = rows.mapInPandas(archives, "archive binary").select(F.col("archive").cast("string").alias("value"))
    files.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, as ``READ_BACK``."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in READ_BACK.split(", ")]
        for batch in batches:
            for archive in batch["content"]:
                found = dict(zip(names, zip(*map(parsed, records_in(bytes(archive))), strict=True), strict=True))
                ids = {c: pd.array(list(found[c]), dtype="Int64") for c in ("page_id", "refers_to")}
                yield pd.DataFrame(found | ids)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(rows, READ_BACK)
