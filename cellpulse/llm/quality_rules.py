"""Host-level quality rules: failure rates by host, shrunk by an empirical beta prior.

Every document is measured alone. The failures of each rule are counted by
host, and a host's rate is drawn towards the rate of all hosts by a beta prior
whose two parameters come from the hosts' own rates (method of moments), so
that a host with three documents is not judged by three documents. A host
whose shrunk rate of a rule passes the limit is marked for that rule. A
document goes if it fails a base rule, or if it fails a rule its host is marked
for; a document without any failure stays, whatever its host.

Defined cases: a null text has no words and fails; a null host is a host of its
own; repeated rows and equal ids are judged row by row; an empty table gives an
empty result. Carried columns travel inside a struct, so they may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.llm.common import SPACES, let, stored, words_of

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
HOST_LIMIT = 0.5
SALTS = 16


def repeat_words(words: Column) -> Column:
    """Words inside a five-word window that the text holds at least twice.

    Windows are compared by a 64-bit hash within one text. Positions of
    repeated windows come from one sort, so a long text costs n log n.
    """

    def of_windows(windows: Column) -> Column:
        def of_sorted(rows: Column) -> Column:
            same = lambda i, x: F.get(rows, i)["key"] == x["key"]
            repeated = F.filter(rows, lambda x, i: same(i - 1, x) | same(i + 1, x))
            starts = F.sort_array(F.transform(repeated, lambda x: x["at"]))
            return let(starts, covered)

        def covered(starts: Column) -> Column:
            new = F.transform(
                starts, lambda x, i: F.least(F.lit(5), F.coalesce(F.get(starts, i + 1) - x, F.lit(5)))
            )
            return F.aggregate(new, F.lit(0).cast("long"), lambda total, x: total + x)

        keyed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("key"), i.alias("at"))))
        unique = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(unique, F.lit(0).cast("long")).otherwise(let(keyed, of_sorted))

    def of_hashes(hashes: Column) -> Column:
        first = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 4, F.lit(0)))
        window = lambda x, i: F.xxhash64(x, *(F.get(hashes, i + k) for k in range(1, 5)))
        return let(F.transform(first, window), of_windows)

    return let(F.transform(words, lambda x: F.xxhash64(x)), of_hashes)


def measure(text: Column) -> Column:
    """A struct of ``MEASURES`` over the whole text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    by_words = lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("again"))
    by_lines = lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("kinds"))
    length = lambda left_out: F.length(F.translate(text, left_out, ""))

    def of(word: Column) -> Column:
        return let(
            let(lines, by_lines),
            lambda line: F.struct(
                word["n"].cast("long").alias("n_words"),
                length(SPACES).cast("long").alias("word_chars"),
                (F.length(text) - length(SYMBOLS)).cast("long").alias("n_symbols"),
                line["n"].cast("long").alias("n_lines"),
                (line["n"] - line["kinds"]).cast("long").alias("n_dup_lines"),
                word["again"].alias("n_repeat_words"),
            ),
        )

    return let(let(words_of(text), by_words), of)


BASE = ("few_words", "repetition")
RULES = ("few_words", "repetition", "symbols", "repeated_lines", "word_length")


def failures(quality: str = "quality") -> list[Column]:
    """One boolean column per rule, from the struct of measures."""
    n = lambda name: F.col(f"{quality}.{name}")
    return [
        (n("n_words") < MIN_WORDS).alias("few_words"),
        (100 * n("n_repeat_words") > MAX_REPEAT_PERCENT * n("n_words")).alias("repetition"),
        (10 * n("n_symbols") > n("n_words")).alias("symbols"),
        (10 * n("n_dup_lines") > 3 * n("n_lines")).alias("repeated_lines"),
        ((n("word_chars") > 15 * n("n_words")) | (n("word_chars") < 2 * n("n_words"))).alias("word_length"),
    ]


def host_rates(rows: DataFrame, host: str) -> DataFrame:
    """Documents and failures of each host, with its shrunk rate of each rule.

    ``rows`` has the columns of ``failures``. Counts combine before the
    shuffle. The prior is ten numbers, which the driver holds.
    """
    counts = rows.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), *(F.count_if(F.col(r)).alias(r) for r in RULES)
    )
    counts = stored(counts, "hosts")
    moments = counts.agg(
        *(F.avg(F.col(r) / F.col("n_docs")).alias(f"{r}_mean") for r in RULES),
        *(F.var_samp(F.col(r) / F.col("n_docs")).alias(f"{r}_var") for r in RULES),
    ).first()
    rates = []
    for r in RULES:
        mean, var = moments[f"{r}_mean"] or 0.0, moments[f"{r}_var"] or 0.0
        # A beta distribution with this mean and variance has alpha + beta = weight.
        if var > 0:
            weight = max(0.0, mean * (1 - mean) / var - 1)
            rate = (F.col(r) + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
        else:
            rate = F.lit(mean)
        rates.append(rate.alias(f"{r}_rate"))
    return counts.select("host", "n_docs", *rates)


def host_marks(rates: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Hosts marked for at least one rule, with the marks."""
    marks = rates.select("host", *((F.col(f"{r}_rate") > limit).alias(f"host_{r}") for r in RULES))
    return marks.where(" or ".join(f"host_{r}" for r in RULES))


def judge(
    docs: DataFrame, carried: list[str], text: str = "text", host: str = "source", limit: float = HOST_LIMIT
) -> DataFrame:
    """The ``carried`` columns in the struct ``row``, with ``quality``, ``base_failed`` and ``kept``.

    The measures are computed once and stored. The host's marks come back by a
    join on the host and a salt, so that a hot host meets in many tasks; a
    small table of marks is broadcast by its size on disk instead.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row"),
        F.col(f"`{host}`").alias("own_host"),
        measure(F.col(f"`{text}`")).alias("quality"),
    )
    rows = stored(rows, "quality")
    rates = host_rates(rows.select("own_host", *failures()), "own_host")
    marks = stored(host_marks(rates, limit), "host_marks")
    marks = marks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = rows.withColumns(
        {
            "own_salt": F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"),
            "failed": F.struct(*failures()),
        }
    )
    joined = own.join(marks, own.own_host.eqNullSafe(marks.host) & (own.own_salt == marks.salt), "left")
    base = F.greatest(*(F.col(f"failed.{r}") for r in BASE))
    by_host = F.greatest(*(F.col(f"failed.{r}") & F.coalesce(f"host_{r}", F.lit(False)) for r in RULES))
    return joined.select("row", "quality", base.alias("base_failed"), (~base & ~by_host).alias("kept"))


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: its measures and whether it stays."""
    return judge(docs, ["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"),
        *(F.col(f"quality.{m}").alias(m) for m in MEASURES if m != "n_lines"),
        "base_failed",
        "kept",
    )


def keep(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns."""
    return judge(docs, docs.columns).where("kept").select("row.*")
