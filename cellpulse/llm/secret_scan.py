"""Secret scans: three fixed patterns, and runs that look more random than named.

Two Markov models over adjacent characters, one of random strings and one of
ordinary identifiers, are trained from labelled samples. A run of token
characters is a secret if the log-likelihood of its transitions under the
first model exceeds that under the second by ``THRESHOLD``. Patterns stay as
they are; the models add spans outside them, and a run that a pattern's span
meets is cut there and each part that is left is judged. No length is asked of a
run: the ratio grows with it, so short strings need the more evidence.

Labels: the values that the patterns find, in all documents, are random
strings; the words of a bounded sample of documents outside of any found
span are ordinary, but for those of ``MIN_CODE`` characters or more that have
digits. ``train`` takes any table of labelled samples instead.

Spans count code points, the end excluded. Defined cases: a null text is
empty and has no span; repeated rows and equal ids are scanned row by row; an
empty table gives an empty result; without random samples their model is
the uniform one; whole texts are scanned whatever their length.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.llm.common import let, stored

#: Fixed values, in the order in which spans of one start are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "model")
MIN_VALUE = 6
#: Runs that the models judge; one character has no transition.
RUN = r"[A-Za-z0-9+/_=-]{2,}"
#: Words from this length on that have digits are not taken for ordinary ones in training.
MIN_CODE = 16
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WIDTH = len(ALPHABET) + 1
THRESHOLD = 12.0
#: Weight of a character's own frequency in the frequency of a transition to it, and what each character has besides its count.
BACKOFF, FLOOR = 4.0, 0.5
#: About so many documents, or all of fewer, give words to the model of ordinary identifiers.
SAMPLE_DOCS = 2000
MARK = "[SECRET]"
#: Code points of one block of a text whose spans are replaced.
BLOCK = 4096
#: Values of a running sum or maximum that are combined one by one.
STRIDE = 128
SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _so_far(values: Column, kind: str, combine: Callable[[Column, Column], Column]) -> Column:
    """For each place of an array, all values up to it combined.

    Values are combined inside blocks, and then the blocks' results, so that no long
    array is appended to one by one. ``combine`` gets null for what comes before the first.
    """
    none = F.array().cast(f"array<{kind}>")
    last = lambda a: F.try_element_at(a, F.lit(-1))

    def of(values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STRIDE).cast("int"))
        blocks = F.transform(numbers, lambda b: F.slice(values, b * STRIDE + 1, F.lit(STRIDE)))
        add = lambda done, x: F.concat(done, F.array(combine(last(done), x)))
        return let(F.transform(blocks, lambda block: F.aggregate(block, none, add)), joined)

    def joined(blocks: Column) -> Column:
        add = lambda done, block: F.concat(done, F.array(combine(last(done), last(block))))
        return let(F.aggregate(blocks, none, add), lambda ends: F.flatten(F.transform(blocks, lambda block, i: moved(block, F.get(ends, i - 1)))))

    def moved(block: Column, before: Column) -> Column:
        return F.transform(block, lambda x: combine(before, x))

    return F.when(F.size(values) == 0, none).otherwise(let(values, of))


def sums(values: Column) -> Column:
    return _so_far(values, "int", lambda before, x: x + F.coalesce(before, F.lit(0)))


def maxima(values: Column) -> Column:
    return _so_far(values, "int", lambda before, x: F.greatest(x, before))


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """Matches of a pattern with their places: the lengths of the pieces between them are summed up."""
    pairs = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda piece, found: F.struct(F.length(piece).alias("gap"), found.alias("found")),
    )

    def placed(pairs: Column) -> Column:
        ends = sums(F.transform(pairs, lambda p: p["gap"] + F.length(p["found"])))
        return F.zip_with(
            pairs,
            ends,
            lambda p, end: F.struct(
                (end - F.length(p["found"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), p["found"].alias("value")
            ),
        )

    paired = F.filter(pairs, lambda p: p["found"].isNotNull())
    return F.when(text.rlike(pattern), let(paired, placed)).otherwise(F.array().cast(SPANS))


def value_of(span: Column) -> Column:
    """The secret itself: what an assignment assigns, or the whole match."""
    return F.when(span["kind"] == 0, F.regexp_extract(span["value"], ASSIGN, 2)).otherwise(span["value"])


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, by start and kind."""
    assigned = F.filter(_spans(text, ASSIGN, 0), lambda s: F.length(value_of(s)) >= MIN_VALUE)
    return F.sort_array(F.concat(assigned, _spans(text, ACCESS, 1), _spans(text, HEX, 2)))


def apart(spans: Column) -> Column:
    """Spans in order of start without what earlier ones cover: ``before`` (where these end), ``start`` and ``end`` of the rest.

    A span is ``new`` if it begins outside of them; one that lies within them is null.
    """
    reach = maxima(F.transform(spans, lambda s: s["end"]))
    return F.zip_with(
        F.zip_with(spans, F.concat(F.array(F.lit(0)), reach), lambda s, r: F.struct(s.alias("s"), r.alias("before"))),
        reach,
        lambda x, r: F.when(x["s"].isNotNull() & (x["s"]["end"] > x["before"]), F.struct(
            x["before"].alias("before"), F.greatest(x["s"]["start"], x["before"]).alias("start"), x["s"]["end"].alias("end"),
            (x["s"]["start"] >= x["before"]).alias("new"),
        )),
    )


def replaced(text: Column, spans: Column, by: Callable[[Column], Column]) -> Column:
    """The text with what spans cover replaced.

    Pieces are taken out of blocks of code points, so that none is searched from the text's beginning.
    """

    def of(x: Column) -> Column:
        blocks, parts = x["blocks"], x["parts"]

        def piece(start: Column, end: Column) -> Column:
            first = F.floor(start / BLOCK).cast("int")
            last = F.floor((F.greatest(end, start + 1) - 1) / BLOCK).cast("int")
            joined = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
            return F.when(end > start, F.substring(joined, start - first * BLOCK + 1, end - start)).otherwise("")

        changed = F.transform(parts, lambda p: F.concat(piece(p["before"], p["start"]), by(p)))
        rest = piece(F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text))
        return F.concat(F.array_join(changed, ""), rest)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    parts = F.filter(apart(spans), lambda p: p.isNotNull())
    known = F.struct(blocks.alias("blocks"), parts.alias("parts"))
    return F.when(F.size(spans) == 0, text).otherwise(let(known, of))


def runs(text: Column, base: Column, score: Callable[[Column], Column]) -> Column:
    """Runs outside of ``base`` that the models take for secrets.

    Base spans are blanked out, so that a run is cut where one meets it. Each
    value is judged once; places are worked out where a secret is found.
    """
    secret = lambda v: v.rlike("[A-Za-z]") & (score(v) > THRESHOLD)  # noqa: E731  a number alone is no secret
    blank = replaced(text, base, lambda p: F.repeat(F.lit(" "), p["end"] - p["start"]))

    def found(text: Column) -> Column:
        values = F.array_distinct(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)))
        placed = F.filter(_spans(text, RUN, 3), lambda s: secret(s["value"]))
        return F.when(F.exists(values, secret), placed).otherwise(F.array().cast(SPANS))

    return let(blank, found)


# ---------------------------------------------------------------- models


def _codes(value: Column) -> Column:
    """A value as places in the alphabet; the last place is any other character."""
    place = lambda c: F.instr(F.lit(ALPHABET), c)
    return F.transform(F.split(value, ""), lambda c: F.when(c == "", 0).otherwise(place(c)))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each transition, from samples ``value``, ``random`` (boolean).

    Every sample is counted; counts combine before the shuffle, and the driver
    holds one number per pair of characters and label.
    """
    pairs = samples.where(F.length("value") > 1).select(
        "random",
        F.explode(
            let(
                _codes(F.col("value")),
                lambda c: F.transform(
                    F.slice(c, F.lit(1), F.size(c) - 1), lambda x, i: x * WIDTH + F.get(c, i + 1)
                ),
            )
        ).alias("pair"),
    )
    counts = {True: [0.0] * WIDTH**2, False: [0.0] * WIDTH**2}
    for row in pairs.where("random is not null").groupBy("random", "pair").count().collect():
        counts[row["random"]][row["pair"]] += row["count"]

    def logs(own: list[float]) -> list[float]:
        to = [sum(own[c::WIDTH]) + FLOOR for c in range(WIDTH)]
        share = [n / sum(to) for n in to]
        after = [sum(own[c * WIDTH : (c + 1) * WIDTH]) for c in range(WIDTH)]
        return [
            math.log((own[i] + BACKOFF * share[i % WIDTH]) / (after[i // WIDTH] + BACKOFF)) for i in range(WIDTH**2)
        ]

    return [round(a - b, 4) for a, b in zip(logs(counts[True]), logs(counts[False]), strict=True)]


def scorer(model: list[float]) -> Callable[[Column], Column]:
    """The log-likelihood ratio of a value under a model, which is a literal of fixed size."""
    ratios = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")

    def score(value: Column) -> Column:
        def total(c: Column) -> Column:
            steps = F.transform(
                F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))),
                lambda x, i: F.get(ratios, x * WIDTH + F.get(c, i + 1)),
            )
            return F.aggregate(steps, F.lit(0.0), lambda t, x: t + x)

        return let(_codes(value), total)

    return score


def ordinary_words(docs: DataFrame, text: str = "text", key: str = "doc_id", limit: int = SAMPLE_DOCS) -> DataFrame:
    """Words of a bounded sample of documents, found spans and long words with digits taken out.

    A hash decides about each document where it lies, so no task gathers the sample.
    """
    steps = 1 << 40
    place = F.pmod(F.xxhash64(F.lit("secret-sample"), F.col(f"`{key}`"), F.col(f"`{text}`")), F.lit(steps))
    share = min(1.0, limit / max(1, docs.count()))
    sample = docs.where(place < round(share * steps)).select(F.col(f"`{text}`").alias("text"))
    plain = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    words = F.regexp_extract_all(plain, F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))
    found = sample.select(F.explode(words).alias("value"), F.lit(False).alias("random"))
    return found.where(f"length(value) < {MIN_CODE} or not value rlike '[0-9]'")


# ---------------------------------------------------------------- documents


def scan(docs: DataFrame, carried: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """The ``carried`` columns in ``row``, with ``base`` and ``spans`` (all spans, by start and kind).

    Texts are searched by the patterns for training, and again when the models judge them.
    """
    kept = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    random = docs.select(F.explode(base_spans(kept)).alias("s")).select(value_of(F.col("s")).alias("value")).distinct()
    random = random.withColumn("random", F.lit(True))
    score = scorer(train(random.unionByName(ordinary_words(docs, text, key))))
    found = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row"), kept.alias("text"), base_spans(kept).alias("base")
    )
    both = let(
        F.struct(F.col("text").alias("text"), F.col("base").alias("base")),
        lambda x: F.struct(x["base"].alias("base"), runs(x["text"], x["base"], score).alias("runs")),
    )
    found = stored(found.select("row", both.alias("b")).select("row", "b.base", "b.runs"), "found")
    return found.select("row", "base", F.sort_array(F.concat("base", "runs")).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    name = lambda s: F.get(F.array(*(F.lit(k) for k in KINDS)), s["kind"])
    one = lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: numbers of spans, their digest, and all spans."""
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scan(docs, ["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"),
        *(of(k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or chain of overlapping spans, replaced by a mark."""
    # A span that begins inside of earlier ones adds to their mark.
    return replaced(text, spans, lambda p: F.when(p["new"], MARK).otherwise(""))


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with secrets replaced, in their own columns; ``n_chars`` follows a changed text."""
    found = scan(docs, docs.columns, text)
    new = redacted(F.col(f"row.`{text}`"), F.col("spans"))
    found = found.select("row", F.size("spans").alias("n"), new.alias("new"))
    columns = []
    for c in docs.columns:
        own = F.col(f"row.`{c}`")
        if c == text:
            own = F.col("new")
        elif c == n_chars:
            own = F.when(F.col("n") > 0, F.length("new").cast("long")).otherwise(own)
        columns.append(own.alias(c))
    return found.select(*columns)
