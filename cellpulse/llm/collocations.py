"""Collocations: phrases of two to five words that are said more often than their parts suggest.

Texts lie in pieces between punctuation marks and line ends, pieces in words
between spaces and tabs. A phrase is a run of words inside a piece; it is a
candidate if it occurs ``MIN_COUNT`` times in its language, overlaps included.

Candidates come from Misra-Gries summaries. A task counts the phrases of a
stretch of text by their hashes and cuts the counts by hash into partitions; the
summaries of one language and partition are merged by one task. A merged
summary that outgrows its capacity, ``SPARE`` times a partition's mean mass divided by
``MIN_COUNT``, loses the same amount from every counter and remembers how much it
has lost. So no phrase loses ``MIN_COUNT`` in all, and each frequent one
survives; where a partition's mass is far above the mean, a loss that would break this makes the
capacity larger instead. There are enough partitions to keep their mass
bounded at every size of the input.

Phrases of three to five words are counted only where all their pairs of
words survived, as no phrase is more frequent than its parts. Survivors travel as a bitmap
of a fixed size; a phrase that passes by chance costs a counter and changes no
result. The last pass counts the survivors exactly, by their words.

A candidate's score is that of its weakest cut into two parts. A candidate
inside a longer one that is as frequent is dropped.

Defined cases: a null text is empty; a null language is ``und``; repeated rows and
equal ids count as often as they occur; a text without a word adds nothing;
an empty table gives an empty result. Only the named columns are read. A text of any length
is read in parts, cut between pieces; a piece without end is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.llm.common import stored
from cellpulse.session import discard

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
#: Words of text to one hash partition, at most.
PARTITION_WORDS = 1 << 24
#: Capacity over what the guarantee needs: a summary loses about a fourth of the threshold, so little passes that is rarer.
SPARE = 4
#: Bytes of text that are divided at once, and counters that a task holds before it hands them on.
CHUNK_BYTES, HELD = 2 << 20, 3 << 20
#: Bits of a bitmap of survivors (8 MB), and how many of them stand for one phrase.
BITS, PROBES = 1 << 26, 4

_U = np.uint64
_LOWER = bytes(range(256)).translate(
    bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 10)
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _constants(seed: int, n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


#: Two hashes of a word: their values of a byte, their bases, and the bases' inverses modulo 2 ** 64.
_VALUES = [_constants(seed, 256) for seed in (11, 12)]
_BASES = [int(_constants(seed, 1)[0]) | 1 for seed in (13, 14)]
_INVERSES = [pow(b, -1, 1 << 64) for b in _BASES]
_STEPS = _constants(15, 2) | _U(1)
_PROBE_FACTORS = _constants(16, PROBES) | _U(1)
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(n, base, _U)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


class Words:
    """The words of a stretch of prepared text: where they lie, their pieces, and their hashes."""

    def __init__(self, data: bytes, both: bool = False):
        self.data = data
        raw = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = (raw != 32) & (raw != 10)
        change = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = change[::2], change[1::2]
        self.pieces = np.cumsum(raw == 10, dtype=np.int32)[self.starts] if len(self.starts) else np.zeros(0, np.int32)
        self.hashes = [self._hashed(raw, i) for i in range(2 if both else 1)]

    def _hashed(self, raw: np.ndarray, i: int) -> np.ndarray:
        total = np.zeros(len(raw) + 1, _U)
        np.cumsum(_VALUES[i][raw] * _powers_of(_BASES[i], len(raw)), out=total[1:])
        found = total[self.ends] - total[self.starts]
        return _mixed(found * _powers_of(_INVERSES[i], len(raw))[self.starts])

    def phrases(self, i: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each number of words from one: which words begin a phrase, and the phrases' hashes."""
        words = self.hashes[i]
        hashes, at = words, np.arange(len(words))
        yield at, hashes
        for k in range(2, LONGEST + 1):
            fits = at + k - 1 < len(words)
            at, hashes = at[fits], hashes[fits]
            fits = self.pieces[at] == self.pieces[at + k - 1]
            at, hashes = at[fits], hashes[fits]
            hashes = _mixed(hashes * _STEPS[i] + words[at + k - 1])
            yield at, hashes


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, bytes]]:
    """Prepared texts of one language, joined by line ends or cut at them into stretches of about the same size."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            ready = bytes(text).translate(_LOWER)
            while len(ready) > CHUNK_BYTES:
                cut = ready.rfind(b"\n", 0, CHUNK_BYTES) + 1 or ready.find(b"\n", CHUNK_BYTES) + 1
                if not cut:
                    break
                yield lang, ready[:cut]
                ready = ready[cut:]
            held.setdefault(lang, []).append(ready)
            sizes[lang] = sizes.get(lang, 0) + len(ready) + 1
            if sizes[lang] >= CHUNK_BYTES:
                yield lang, b"\n".join(held.pop(lang))
                sizes[lang] = 0
    for lang, texts in held.items():
        yield lang, b"\n".join(texts)


def _added(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One counter for each hash."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, int)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


class Summary:
    """A Misra-Gries summary whose losses stay below the threshold."""

    def __init__(self, threshold: int, capacity: int):
        self.threshold, self.capacity, self.lost, self.waiting = threshold, capacity, 0, 0
        self.hashes, self.counts, self.parts = np.zeros(0, _U), np.zeros(0, np.int64), []

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((hashes, counts))
        self.waiting += len(hashes)
        if self.waiting > self.capacity:
            self._merge()

    def _merge(self) -> None:
        parts = [(self.hashes, self.counts), *self.parts]
        self.hashes, self.counts = _added(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        self.parts, self.waiting = [], 0
        while len(self.counts) > self.capacity:
            loss = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            if self.lost + loss >= self.threshold:
                self.capacity *= 2
                continue
            self.lost += loss
            stays = self.counts > loss
            self.hashes, self.counts = self.hashes[stays], self.counts[stays] - loss

    def survivors(self) -> np.ndarray:
        """The hashes that may occur as often as the threshold; what does so is among them."""
        self._merge()
        return self.hashes[self.counts + self.lost >= self.threshold]


def _probes(hashes: np.ndarray) -> np.ndarray:
    """The places of the bitmap that stand for each hash."""
    return ((hashes[:, None] * _PROBE_FACTORS[None, :]) >> _U(64 - (BITS.bit_length() - 1))).astype(np.int64)


def _passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for factor in _PROBE_FACTORS:
        at = (hashes * factor) >> _U(64 - (BITS.bit_length() - 1))
        found &= (bitmap[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1
    return found


def _in_language(lang: str) -> np.uint64:
    """What sets a language's phrases apart from the same phrases of another."""
    return _mixed(np.frombuffer(lang.encode("utf-8", "surrogatepass").ljust(8, b"\0")[:8], _U).copy() + _U(len(lang)))[0]


def _frequent(texts: DataFrame, partitions: int, lengths: range, pairs, threshold: int, capacity: int) -> DataFrame:
    """The places of the bitmap for all phrases of these lengths that may be frequent."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap = None if pairs is None else np.frombuffer(pairs.value, np.uint8)
        held, size = {}, 0
        for lang, data in _stretches(batches):
            words, own = Words(data), _in_language(lang)
            frequent = None
            for k, (at, hashes) in enumerate(words.phrases(), 1):
                if k == 2 and bitmap is not None:
                    frequent = np.zeros(len(words.starts) + 1, bool)
                    frequent[at[_passes(bitmap, hashes ^ own)]] = True
                if k not in lengths:
                    continue
                if frequent is not None:
                    keep = np.ones(len(at), bool)
                    for j in range(k - 1):
                        keep &= frequent[at + j]
                    hashes = hashes[keep]
                found = np.unique(hashes ^ own, return_counts=True)
                held.setdefault(lang, []).append(found)
                size += len(found[0])
            if size > HELD:
                yield from parted(held)
                held, size = {}, 0
        yield from parted(held)

    def parted(held: dict) -> Iterator[pd.DataFrame]:
        for lang, parts in held.items():
            hashes, counts = _added(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            part = (hashes % _U(partitions)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(partitions + 1))
            hashes, counts = hashes[order], counts[order].astype(np.uint32)
            for p in np.flatnonzero(bounds[1:] > bounds[:-1]):
                own = slice(bounds[p], bounds[p + 1])
                yield pd.DataFrame(
                    {"lang": [lang], "part": [int(p)], "hashes": [hashes[own].tobytes()], "counts": [counts[own].tobytes()]}
                )

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, summary = None, None
        for batch in batches:
            for lang, part, hashes, counts in batch[["lang", "part", "hashes", "counts"]].itertuples(index=False):
                if key != (lang, part):
                    if summary is not None:
                        yield pd.DataFrame({"place": _probes(summary.survivors()).ravel()})
                    key, summary = (lang, part), Summary(threshold, capacity)
                summary.add(np.frombuffer(hashes, _U), np.frombuffer(counts, np.uint32).astype(np.int64))
        if summary is not None:
            yield pd.DataFrame({"place": _probes(summary.survivors()).ravel()})

    summaries = texts.mapInPandas(counted, "lang string, part int, hashes binary, counts binary")
    dealt = summaries.repartition(F.col("lang"), F.col("part")).sortWithinPartitions("lang", "part")
    return dealt.mapInPandas(merged, "place long")


def _bitmap(places: DataFrame) -> bytes:
    """All places as one bitmap of a fixed size, put together by Spark in parts of 4 KB."""
    parts = places.groupBy(F.expr("bitmap_bucket_number(place + 1)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place + 1))").alias("bits")
    )
    found = np.zeros(BITS // 8, np.uint8)
    for bucket, bits in parts.select("bucket", "bits").collect():
        found[(bucket - 1) * 4096 : bucket * 4096] |= np.frombuffer(bytes(bits), np.uint8)
    return found.tobytes()


def _exact(texts: DataFrame, kept, partitions: int, min_count: int) -> DataFrame:
    """``lang``, ``phrase`` and ``f`` of all phrases in the bitmap that occur often enough, one word included.

    Counts travel in one row for each task, language and partition, and are added by their words.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap = np.frombuffer(kept.value, np.uint8)
        held: dict[str, dict[bytes, int]] = {}
        for lang, data in _stretches(batches):
            words, own = Words(data, both=True), _in_language(lang)
            mine = held.setdefault(lang, {})
            for k, ((at, first), (_, second)) in enumerate(zip(words.phrases(0), words.phrases(1), strict=True), 1):
                keep = np.flatnonzero(_passes(bitmap, first ^ own))
                at, first, second = at[keep], first[keep], second[keep]
                order = np.lexsort((second, first))
                at, first, second = at[order], first[order], second[order]
                new = np.ones(len(at), bool)
                new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
                begins = np.flatnonzero(new)
                counts = np.diff(np.append(begins, len(at)))
                for i, n in zip(at[begins].tolist(), counts.tolist(), strict=True):
                    phrase = data[words.starts[i] : words.ends[i + k - 1]]
                    if b"  " in phrase:
                        phrase = b" ".join(x for x in phrase.split(b" ") if x)
                    mine[phrase] = mine.get(phrase, 0) + n
            if sum(map(len, held.values())) > 300_000:
                yield from parted(held)
                held = {}
        yield from parted(held)

    def parted(held: dict[str, dict[bytes, int]]) -> Iterator[pd.DataFrame]:
        for lang, counts in held.items():
            parts: dict[int, list[bytes]] = {}
            for phrase in counts:
                parts.setdefault(crc32(phrase) % partitions, []).append(phrase)
            for part, phrases in parts.items():
                numbers = np.array([counts[x] for x in phrases], np.int64).tobytes()
                yield pd.DataFrame({"lang": [lang], "part": [part], "phrases": [b"\n".join(phrases)], "counts": [numbers]})

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total = None, {}
        for batch in batches:
            for lang, part, phrases, counts in batch[["lang", "part", "phrases", "counts"]].itertuples(index=False):
                if key != (lang, part):
                    yield from frequent(key, total)
                    key, total = (lang, part), {}
                for phrase, n in zip(bytes(phrases).split(b"\n"), np.frombuffer(counts, np.int64).tolist(), strict=True):
                    total[phrase] = total.get(phrase, 0) + n
        yield from frequent(key, total)

    def frequent(key: tuple[str, int] | None, total: dict[bytes, int]) -> Iterator[pd.DataFrame]:
        found = [(key[0], x.decode("utf-8"), n) for x, n in total.items() if n >= min_count]
        if found:
            yield pd.DataFrame(found, columns=["lang", "phrase", "f"])

    counted = texts.mapInPandas(count, "lang string, part int, phrases binary, counts binary")
    dealt = counted.repartition(F.col("lang"), F.col("part")).sortWithinPartitions("lang", "part")
    return dealt.mapInPandas(added, "lang string, phrase string, f long")


def _n_words(text: Column) -> Column:
    """A word ends where a piece does: at spaces, tabs and the marks between pieces."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+")), F.lit(0)).cast("long")


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT) -> DataFrame:
    """Exact counts ``f`` of all phrases of one to five ``words`` that occur ``min_count`` times in their language."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    total = docs.agg(F.sum(_n_words(F.col(f"`{text}`")))).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION_WORDS))

    def found(lengths: range, pairs) -> DataFrame:
        capacity = SPARE * len(lengths) * total // (partitions * min_count) + 1024
        return _frequent(texts, partitions, lengths, pairs, min_count, capacity)

    short = stored(found(range(1, 3), None), "short_phrases")
    pairs = spark.sparkContext.broadcast(_bitmap(short))
    every = short.unionByName(found(range(3, LONGEST + 1), pairs))
    kept = spark.sparkContext.broadcast(_bitmap(every))
    counted = _exact(texts, kept, partitions, min_count)
    result = stored(counted.withColumn("words", F.size(F.split("phrase", " "))), "phrase_counts")
    discard(short)
    return result


def _part(words, first: int, n) -> Column:
    return F.array_join(F.slice(words, F.lit(first) if isinstance(first, int) else first, n), " ")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP
) -> DataFrame:
    """The best ``top`` collocations of each language: ``rank``, ``phrase``, counts ``a``, ``l``, ``r``, ``n`` and ``score``."""
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    counts = phrase_counts(rows, min_count=min_count)
    sizes = rows.groupBy(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    sizes = sizes.agg(F.sum(_n_words(F.col("text"))).alias("n"))
    long = counts.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("parts"))
    cuts = long.select("lang", "phrase", "a", "parts", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        _part(F.col("parts"), 1, F.col("k")).alias("left"),
        _part(F.col("parts"), F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
    )
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(stored(sizes, "sizes"), "lang")
    score = F.expr("(cast(a as decimal(18,0)) * 1000 * cast(n as decimal(16,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r", "n")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")
    inner = long.where("words > 2").select("lang", "a", "parts", "words", F.explode(F.expr("sequence(2, words - 1)")).alias("m"))
    inner = inner.select("lang", "a", "parts", "m", F.explode(F.expr("sequence(1, words - m + 1)")).alias("i"))
    inner = inner.select(F.col("lang"), _part(F.col("parts"), F.col("i"), F.col("m")).alias("phrase"), F.col("a").alias("longer"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    stays = scored.join(covered, ["lang", "phrase"], "left").where("longer is null or longer < a").drop("longer")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = stays.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
