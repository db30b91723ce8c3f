"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Each source has a weight and may be repeated ``max_epochs`` times at most. The
words of the mix are shared by weight; sources over their cap are clamped to
it and the excess is shared by weight among the others, until none is above.
A source's target then becomes whole repetitions of all its documents and a
fractional one: documents in the order of a seeded hash until the rest is
filled, the last one in part. Targets are so met to the word.

The cut of the fractional repetition is found without ordering a source:
4,096 hash ranges are summed first, and only the documents of the range that
holds the cut are looked at one by one.

Defined cases: a null or empty text has no words and none is taken; a null
source is a source of its own, last in order; rows of equal id are told apart by their
texts, and if these are equal too, the part that the cut leaves them is divided evenly (fewer words
than there are such rows may be left out); a table without words
gives targets of zero; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.llm.common import SPACE, count_words, stored

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
SEED = "mix-1"
SALTS = 16
#: Leading hex digits of the hash that make a range.
RANGE_DIGITS = 3


def weighted_sources(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source with its size and weight, weights repeating in the order of code points.

    Sources are ordered by ranges: each range numbers its own, and the driver
    holds one count per range.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.col("source").asc_nulls_last()
    ranged = stored(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    before, offsets = 0, {}
    for part, n in sorted(ranged.groupBy("part").count().collect()):
        offsets[part], before = before, before + n
    own = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    pairs = [F.lit(x) for pair in offsets.items() for x in pair]
    start = F.create_map(*pairs)[F.col("part")] if pairs else F.lit(0)
    place = (own + start) % len(weights)
    return ranged.select(
        "source", "source_size", F.get(F.array(*(F.lit(w) for w in weights)), place.cast("int")).alias("weight")
    )


def water_fill(
    sources: DataFrame, share_percent: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS
) -> tuple[DataFrame, float]:
    """``sources`` with the column ``target``, and the level: target per weight where no cap holds.

    Each round clamps the sources above their cap and shares the excess anew;
    it is one aggregation to three numbers. Levels only rise, so it ends.
    """
    cap = max_epochs * F.col("source_size")

    def left(level: float | None) -> tuple[int, int]:
        over = F.lit(False) if level is None else cap < level * F.col("weight")
        row = sources.agg(
            F.sum("source_size").alias("size"),
            F.sum(F.when(over, cap).otherwise(0)).alias("clamped"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        return share_percent * (row["size"] or 0) / 100 - (row["clamped"] or 0), row["free"] or 0

    level, free = None, None
    while True:
        rest, now_free = left(level)
        if now_free in (0, free):
            break
        level, free = rest / now_free, now_free
    level = level or 0.0
    return sources.withColumn("target", F.least(cap.cast("double"), level * F.col("weight"))), level


def mixed(
    docs: DataFrame,
    carried: list[str],
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    seed: str = SEED,
    weights: tuple[int, ...] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """The ``carried`` columns in ``row``, with ``size``, ``source_size``, ``target``, ``taken`` words."""
    # Rows of equal id come in the order of a hash of their texts.
    hashed = F.concat(
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))),
        F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))),
    )
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row"),
        F.col(f"`{source}`").alias("source"),
        count_words(F.col(f"`{text}`")).alias("size"),
        hashed.alias("hash"),
    )
    rows = stored(rows, "sized")
    sources, _ = water_fill(weighted_sources(rows, weights), share_percent, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("whole", whole.cast("long")).withColumn(
        "extra", F.round("target").cast("long") - F.col("whole") * F.col("source_size")
    )
    sources = stored(cuts(rows, sources), "cuts")
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = salted.withColumnRenamed("source", "of_source")
    salt = F.pmod(F.xxhash64("hash"), F.lit(SALTS)).cast("int")
    joined = rows.withColumn("own_salt", salt).join(
        salted, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("own_salt") == F.col("salt"))
    )
    part = (
        F.when(F.col("extra") >= F.col("source_size"), F.col("size"))
        .when(F.col("hash") < F.col("cut"), F.col("size"))
        .when(F.col("hash") == F.col("cut"), F.least(F.col("size"), F.col("cut_words")))
        .otherwise(F.lit(0))
    )
    return joined.select(
        "row", "size", "source_size", "target", "whole", (F.col("whole") * F.col("size") + part).cast("long").alias("taken")
    )


def cuts(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with the hash at which the fractional repetition ends, and the words left to it."""
    bucket = F.substring("hash", 1, RANGE_DIGITS)
    sums = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
    goal = sources.select(F.col("source").alias("of_source"), "extra")
    holds = (F.col("before") <= F.col("extra")) & (F.col("extra") < F.col("before") + F.col("size"))
    here = sums.join(goal, F.col("source").eqNullSafe(F.col("of_source"))).where(holds)
    here = here.select("of_source", F.col("bucket").alias("of_bucket"), "before", "extra")
    near = rows.select("source", "hash", "size", bucket.alias("bucket")).join(
        here, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket"))
    )
    tied = near.groupBy("source", "hash", "before", "extra").agg(
        F.sum("size").alias("size"), F.count("*").alias("n")
    )
    running = Window.partitionBy("source").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    tied = tied.withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(running), F.lit(0)))
    at = tied.where((F.col("start") <= F.col("extra")) & (F.col("extra") < F.col("start") + F.col("size")))
    at = at.select(
        F.col("source").alias("of_source"),
        F.col("hash").alias("cut"),
        F.expr("(extra - start) div n").alias("cut_words"),
    )
    return sources.join(at, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source")


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words taken."""
    return mixed(docs, ["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word; ``n`` is at least 1 and less than its words."""
    leading = F.when(text.rlike("^" + SPACE), 1).otherwise(0)
    rest = F.try_element_at(F.split(text, SPACE + "+", n + leading + 1), F.lit(-1))
    return F.rtrim(F.left(text, F.length(text) - F.length(rest)), F.lit(" \t\n\x0b\x0c\r"))


def repeat(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The mix itself: a row per repetition, with the columns of ``docs``; a part repetition is a shorter text."""
    rows = mixed(docs, docs.columns).where("taken > 0")
    whole = F.expr("taken div size")
    part = F.expr("taken % size")
    copies = F.explode(F.sequence(F.lit(1), (whole + F.when(part > 0, 1).otherwise(0)).cast("int")))
    rows = rows.select("row", part.cast("int").alias("part"), whole.alias("all"), copies.alias("copy"))
    short = F.col("copy") > F.col("all")
    kept = F.col(f"row.`{text}`")
    cut = F.when(short, first_words(kept, F.col("part"))).otherwise(kept)
    columns = []
    for c in docs.columns:
        own = F.col(f"row.`{c}`")
        if c == text:
            own = cut
        elif c == n_chars:
            own = F.when(short, F.length(cut).cast("long")).otherwise(own)
        columns.append(own.alias(c))
    return rows.select(*columns)
