"""License scans: sparse TF-IDF cosine to templates, then inheritance from directories.

Every text is cut into statements (lines, and sentences in them). Statements
that share a term with a template are its vectors, stop words left out; any
other has a cosine of zero. Document frequencies are counted over all such
statements of all files. A file has the license of its best statement, if the
cosine reaches ``MIN_COSINE``. A file without one inherits from the license
file (``LICENSE`` or ``COPYING``) in the nearest directory above it.

Defined cases: a null text has no license, and a null path neither inherits
nor passes on; of equal cosines the name that comes first wins; repeated rows
are judged row by row, equal paths as one file; an empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.llm.common import attach, stored

#: Short notices, by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-2-Clause": "Redistribution permitted under the BSD 2-Clause Simplified License",
    "BSD-3-Clause": "Redistribution permitted under the BSD 3-Clause New License",
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License (CC BY 4.0)",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, version 2.0",
}
#: Words that carry no meaning here.
STOP_WORDS = tuple("a an and by for in is of on or released subject terms the this to under with work".split())
MIN_COSINE = 0.6
LICENSE_FILE = r"(^|/)(LICENSE|COPYING)[^/]*$"
STATEMENTS = r"\n|(?<=[.!?])\x20"


def terms_in(text: str) -> list[str]:
    return [t for t in re.findall("[a-z0-9]+", text.lower()) if t not in STOP_WORDS]


def template_terms(templates: dict[str, str]) -> list[str]:
    return sorted({t for text in templates.values() for t in terms_in(text)})


def terms_of(text: Column) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*STOP_WORDS))


def statements(files: DataFrame, templates: dict[str, str]) -> DataFrame:
    """``path``, ``place`` and ``terms`` of each statement that shares a term with a template."""
    anchors = "|".join(template_terms(templates))
    pattern = rf"(?i)(?<![a-z0-9])({anchors})(?![a-z0-9])"
    rows = files.select("path", "text").where(F.col("path").isNotNull() & F.col("text").rlike(pattern)).distinct()
    cut = rows.select("path", F.posexplode(F.split("text", STATEMENTS)).alias("place", "statement"))
    cut = cut.where(F.col("statement").rlike(pattern))
    # Texts of one path are one file: places may meet, statements do not.
    return cut.select("path", F.xxhash64("place", "statement").alias("place"), terms_of(F.col("statement")).alias("terms"))


def cosines(found: DataFrame, templates: dict[str, str]) -> DataFrame:
    """``path``, ``license`` and ``cosine`` of every statement and template that share a term."""
    spark = found.sparkSession
    n = found.count()
    tf = found.select("path", "place", F.explode("terms").alias("term")).groupBy("path", "place", "term")
    tf = tf.agg(F.count("*").alias("tf"))
    df = stored(tf.groupBy("term").agg(F.count("*").alias("df")), "license_terms")
    idf = lambda: F.log((1 + F.lit(n)) / (1 + F.coalesce("df", F.lit(0)))) + 1
    rows = [(name, t) for name, text in templates.items() for t in terms_in(text)]
    notes = spark.createDataFrame(rows, "license string, own_term string").groupBy("license", "own_term")
    few = df.where(F.col("term").isin(template_terms(templates)))
    notes = notes.agg(F.count("*").alias("own_tf")).join(few, F.col("own_term") == F.col("term"), "left")
    notes = notes.select("license", "own_term", (F.col("own_tf") * idf()).alias("own_weight"))
    norms = notes.groupBy(F.col("license").alias("of")).agg(F.sqrt(F.sum(F.col("own_weight") ** 2)).alias("own_norm"))
    # One row for each template and term: as many as the templates have, whatever the input.
    notes = F.broadcast(notes.join(norms, F.col("license") == F.col("of")).drop("of"))
    weighted = attach(tf, df.withColumnRenamed("term", "of"), "term", "of", "place").select(
        "path", "place", "term", (F.col("tf") * idf()).alias("weight")
    )
    matched = weighted.join(notes, F.col("term") == F.col("own_term"), "left")
    by_term = matched.groupBy("path", "place", "term", "weight").agg(
        F.collect_list(F.when(F.col("license").isNotNull(), F.struct("license", "own_weight", "own_norm"))).alias("notes")
    )
    norm = by_term.groupBy("path", "place").agg(
        F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"),
        F.flatten(
            F.collect_list(
                F.transform(
                    "notes",
                    lambda x: F.struct(
                        x["license"].alias("license"), (x["own_weight"] * F.col("weight") / x["own_norm"]).alias("dot")
                    ),
                )
            )
        ).alias("dots"),
    )
    each = norm.select("path", "place", "norm", F.explode("dots").alias("d"))
    sums = each.groupBy("path", "place", "norm", F.col("d.license").alias("license")).agg(F.sum("d.dot").alias("dot"))
    return sums.select("path", "license", F.round(F.col("dot") / F.col("norm"), 9).alias("cosine"))


def own_licenses(files: DataFrame, templates: dict[str, str], min_cosine: float = MIN_COSINE) -> DataFrame:
    """``path``, ``own`` and ``cosine`` of files that state a license."""
    found = stored(statements(files, templates), "statements")
    best = cosines(found, templates).where(F.col("cosine") >= min_cosine).groupBy("path", "license")
    best = best.agg(F.max("cosine").alias("cosine")).groupBy("path")
    first = F.min(F.struct((-F.col("cosine")).alias("order"), "license", "cosine")).alias("m")
    return best.agg(first).select("path", F.col("m.license").alias("own"), F.col("m.cosine").alias("cosine"))


def directory(path: Column) -> Column:
    """The path up to its last slash; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """A directory and all above it, each with its depth; the top is depth 0."""
    parts = F.filter(F.split(folder, "/"), lambda x: x != "")
    depth = F.sequence(F.lit(0), F.size(parts))
    return F.transform(
        depth, lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, F.lit(1), d), "/").alias("folder"))
    )


def license_scan(
    files: DataFrame, templates: dict[str, str] | None = None, min_cosine: float = MIN_COSINE
) -> DataFrame:
    """``files`` (``doc_id``, ``path``, ``text``) with license, its origin, cosine and directory of origin.

    Directories are made distinct before they look above themselves, and files
    find their directory's answer by directory and salt. Tables that grow with
    the files are merged; only those of the templates are broadcast.
    """
    templates = templates or TEMPLATES
    own = stored(own_licenses(files, templates, min_cosine), "own_licenses")
    granted = own.where(F.col("path").rlike(LICENSE_FILE)).select(
        directory(F.col("path")).alias("granting"), "own", "cosine", "path"
    )
    granted = granted.groupBy("granting").agg(
        F.min(F.struct((-F.col("cosine")).alias("order"), "own", "path")).alias("g")
    )
    folders = files.where(F.col("path").isNotNull()).select(directory(F.col("path")).alias("folder")).distinct()
    above = folders.select("folder", F.inline(ancestors(F.col("folder"))).alias("depth", "above"))
    near = attach(above, granted, "above", "granting", "folder").where(F.col("granting").isNotNull())
    near = near.groupBy("folder").agg(F.max(F.struct("depth", F.col("g.own").alias("own"), "granting")).alias("n"))
    near = stored(
        near.select(F.col("folder").alias("in_folder"), F.col("n.own").alias("inherited"), F.col("n.granting").alias("granting")),
        "folders",
    )
    rows = files.select("doc_id", "path", directory(F.col("path")).alias("folder"))
    rows = rows.join(own.withColumnRenamed("path", "own_path").hint("merge"), F.col("path") == F.col("own_path"), "left")
    rows = attach(rows, near, "folder", "in_folder", "path")
    stated = F.col("own").isNotNull()
    return rows.select(
        "doc_id",
        "path",
        F.coalesce("own", "inherited").alias("license"),
        F.when(stated, "stated").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.round("cosine", 6).alias("cosine"),
        F.when(~stated, F.col("granting")).alias("inherited_from"),
    )


def as_files(documents: DataFrame, width: int = 64) -> DataFrame:
    """Documents laid out as files: ``source/lang/folder/name``.

    A folder holds ``width`` consecutive ids of one source and language; the
    first id of each folder is its license file, and of every ``width`` folders
    one such file lies at the top of the language.
    """
    folder = F.expr(f"doc_id div {width}")
    base = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    path = (
        F.when(F.col("doc_id") % (width * width) == 0, F.concat(base, F.lit("/LICENSE-"), F.col("doc_id")))
        .when(F.col("doc_id") % width == 0, F.concat(base, F.lit("/"), folder, F.lit("/LICENSE")))
        .otherwise(F.concat(base, F.lit("/"), folder, F.lit("/"), F.col("doc_id"), F.lit(".txt")))
    )
    return documents.select("doc_id", path.alias("path"), "text")
