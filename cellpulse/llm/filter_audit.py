"""What each filter of a chain removes, for every order in which the filters could be applied.

One id table is stored for each filter: the ids of the documents that fail it. All ids
go through these tables one after the other: a left-semi join gives those that a
filter removes, a left-anti join its survivors, and both go on, marked by what they
have failed. So the survivors of every prefix of the chain, and what each
further filter takes from them or finds gone already, stand apart at the end. Labels are
id tables of the same kind; a semi join with them marks what a removal loses.
Which filters come before a step is all that matters, not their order, so the steps of all 120
orders are sums over at most 128 groups of ids a part.

An id is two hashes: one of ``doc_id`` and one of the id, the part and the text. Defined cases:
a null text is empty; a null part is the part ``""``; a null id has no label and is no
copy's smaller id, and such a document is never a copy; repeated rows are counted as
often as they occur and are no copies of each other (their id is not smaller), but
of an equal text with a smaller id; several labels of one id count if one of them says so; an empty
table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.llm.common import stored, words_of
from cellpulse.session import discard

MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 50, 65, 5
SYMBOLS = "#$%&*|"
KEYS = ["id_hash", "row_hash"]
#: How labels are marked among the letters of the filters.
LABELS = {"g": "quality", "t": "toxic"}


def conditions(text: Column) -> dict[str, Column]:
    """What the failure conditions ask of a text."""
    n_upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    words = words_of(text)
    return {
        "n_words": F.size(words),
        "n_distinct": F.size(F.array_distinct(words)),
        "n_upper": n_upper,
        "n_chars": F.length(text),
        "has_symbol": text.rlike(f"[{SYMBOLS}]"),
    }


def measured(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """``doc_id``, ``part``, ``digest`` and what the filters ask, without the texts."""
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    return rows.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.xxhash64(F.col("doc_id")).alias("id_hash"),
        F.xxhash64(F.lit("row"), F.col("doc_id"), F.col("part"), F.col("text")).alias("row_hash"),
        *(c.alias(n) for n, c in conditions(F.col("text")).items()),
    )


def failing(facts: DataFrame) -> dict[str, DataFrame]:
    """For each filter, the rows that fail it."""
    of_text = {
        "A": F.col("n_words") < MIN_WORDS,
        "B": 100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"),
        "C": 100 * F.col("n_upper") > MAX_UPPER_PERCENT * F.col("n_chars"),
        "D": F.col("has_symbol"),
    }
    narrow = facts.select("doc_id", "part", *KEYS, "digest", *(c.alias(n) for n, c in of_text.items()))
    several = narrow.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    several = several.where("last_id > first_id").select(F.col("digest").alias("copied"), "first_id")
    copies = narrow.join(several, F.col("digest") == F.col("copied")).where("doc_id > first_id")
    rows = {name: narrow.where(name) for name in of_text} | {"E": copies}
    return {name: r.select("doc_id", "part", *KEYS) for name, r in rows.items()}


def labelled(facts: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
    """For each kind of label, the ids that have it."""
    of = lambda column: labels.where(F.col(column) == 1).select("doc_id")
    return {mark: facts.join(of(column), "doc_id", "left_semi") for mark, column in LABELS.items()}


def divide(rows: DataFrame, mark: str, ids: DataFrame) -> DataFrame:
    """Rows that an id table holds, marked, and those that it does not."""
    taken = rows.join(ids, KEYS, "left_semi").withColumn("failed", F.concat("failed", F.lit(mark)))
    return taken.unionByName(rows.join(ids, KEYS, "left_anti"))


def groups_of(facts: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """``part``, ``failed`` (the marks of all id tables that hold an id, in order) and ``n``."""
    rows = stored(facts.select("part", *KEYS, F.lit("").alias("failed")), "ids")
    for mark, ids in tables.items():
        ids = stored(ids.select(*KEYS).distinct(), f"ids_{mark}")
        divided = stored(divide(rows, mark, ids), "divided")
        discard(rows, ids)
        rows = divided
    counts = stored(rows.groupBy("part", "failed").agg(F.count("*").alias("n")), "groups")
    discard(rows)
    return counts


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step; ``labels`` has ``doc_id``, ``quality`` and ``toxic``."""
    facts = stored(measured(docs, key, text, part), "facts")
    filters = failing(facts)
    groups = groups_of(facts, filters | labelled(facts, labels))
    discard(facts)
    return by_order(groups, "".join(filters))


def by_order(groups: DataFrame, filters: str) -> DataFrame:
    """All orders and steps of each part, zeros included, from the groups of its ids."""
    sets = [
        F.struct(F.lit("".join(before)).alias("before"), F.lit(x).alias("filter"))
        for x in filters
        for k in range(len(filters))
        for before in combinations([y for y in filters if y != x], k)
    ]
    rows = groups.select("part", "failed", "n", F.inline(F.array(*sets)))
    fails, gone = F.col("failed").contains(F.col("filter")), F.expr("translate(failed, before, '') <> failed")
    only = F.expr(f"translate(failed, '{''.join(LABELS)}', '')") == F.col("filter")
    n = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    known = rows.groupBy("part", "before", "filter").agg(
        n(~fails & ~gone).alias("kept"),
        n(fails & ~gone).alias("removed"),
        n(fails & gone).alias("redundant"),
        n(only).alias("unique_fails"),
        *[n(fails & ~gone & F.col("failed").contains(mark)).alias(f"{name}_lost") for mark, name in (("g", "good"), ("t", "toxic"))],
    )
    steps = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"),
            F.lit(k + 1).alias("step"),
            F.lit(order[k]).alias("filter"),
            F.lit("".join(sorted(order[:k]))).alias("before"),
        )
        for order in permutations(filters)
        for k in range(len(filters))
    ]
    parts = groups.select("part").distinct().select("part", F.inline(F.array(*steps)))
    of_filter = Window.partitionBy("part", "filter")
    return parts.join(known, ["part", "filter", "before"]).select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        "kept",
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(of_filter).alias("shapley"),
    )
