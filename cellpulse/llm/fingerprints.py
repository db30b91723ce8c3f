"""Document fingerprints by locally consistent parsing.

A text is parsed into a hierarchy of phrases. On each level runs of one name
are joined, deterministic coin tossing shrinks the names to a few labels of
which no two neighbours are equal, and a phrase begins at each local maximum of
the labels. The name of a phrase is a hash of the names in it. Where a phrase
begins depends on a few names around it only, so a passage that stands in two
texts is parsed the same way in both, but for its ends, whatever stands before.

A fingerprint is the ``SIZE`` smallest of the 32-bit hashes of all phrase names
from ``LEVEL`` on and of the name of the whole text; likeness estimates how
much two such sets of names have in common, relative to their union.

Defined cases: a null text is empty, an empty text has an empty fingerprint,
and two empty ones are alike; repeated rows and equal ids follow one another in
the order of their texts' digests; a null id comes last; an empty table gives an empty
result; of a single row the next one is itself. A whole text is held in
memory with about a hundred bytes a character. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellpulse.llm.common import stored

SIZE = 48
LEVEL = 2
ROUNDS = 3
#: Texts are parsed together until they have so many characters.
CHUNK = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _join_runs(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one name become one name, made of it and the length."""
    new = first.copy()
    new[1:] |= names[1:] != names[:-1]
    if new.all():
        return names, first
    at = np.flatnonzero(new)
    length = np.diff(at, append=len(names)).astype(np.uint64)
    kept = names[at]
    return np.where(length > 1, _mixed(kept + length * _M1), kept), first[at]


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Few labels, unequal between neighbours, that depend on a few names to the left."""
    label = names
    for _ in range(ROUNDS):
        differ = np.empty_like(label)
        differ[1:] = label[1:] ^ label[:-1]
        differ[first] = 1
        one = label.dtype.type(1)
        low = np.bitwise_count((differ & (~differ + one)) - one)  # place of the lowest bit that differs
        label = (low << np.uint8(1)) | ((label >> low.astype(label.dtype)) & one).astype(np.uint8)
    return label


def _phrases(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level: names of phrases, and which of them begin a text."""
    label = _labels(names, first)
    start = first.copy()
    above = np.ones(len(names), bool)
    above[:-1] = (label[:-1] > label[1:]) | first[1:]
    # Not right behind a text's beginning, so that every level is shorter than the one before.
    start[1:] |= above[1:] & (label[1:] > label[:-1]) & ~first[:-1]
    at = np.flatnonzero(start)
    length = np.diff(at, append=len(names))
    place = np.arange(len(names)) - np.repeat(at, length)
    total = np.add.reduceat(_mixed(names + _PLACES[place & 255]) * _PLACES[(place >> 8) & 255], at)
    return _mixed(total + length.astype(np.uint64) * _M2), first[at]


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """The sorted 32-bit hashes of each text."""
    found, begin = [], 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= CHUNK):
            size += len(texts[end])
            end += 1
        found += _parsed(texts[begin:end])
        begin = end
    return found


def _parsed(texts: list[str]) -> list[np.ndarray]:
    lengths = np.array([len(t) for t in texts])
    full = np.flatnonzero(lengths)
    empty = np.empty(0, ">u4")
    out: list[np.ndarray] = [empty] * len(texts)
    if not len(full):
        return out
    data = "".join(texts).encode("utf-32-le", "surrogatepass")
    names = np.frombuffer(data, "<u4").astype(np.uint64) + np.uint64(1)
    first = np.zeros(len(names), bool)
    first[np.concatenate(([0], np.cumsum(lengths[full])[:-1]))] = True
    kept, owner, level = [], full, 0
    while True:
        of = owner[np.cumsum(first) - 1]
        top = first.copy()
        top[:-1] &= first[1:]  # the only name of its text
        take = slice(None) if level >= LEVEL else top
        kept.append((of[take].astype(np.uint64) << np.uint64(32)) | (_mixed(names[take] + _M2) >> np.uint64(32)))
        if top.any():  # texts that are parsed to the end drop out
            rest = ~top
            gone = np.zeros(len(texts), bool)
            gone[of[top]] = True
            names, first, owner = names[rest], first[rest], owner[~gone[owner]]
            if not len(names):
                break
        names, first = _phrases(*_join_runs(names, first))
        level += 1
    keys = np.unique(np.concatenate(kept))
    of = (keys >> np.uint64(32)).astype(np.int64)
    begins = np.searchsorted(of, full)
    ends = np.minimum(np.searchsorted(of, full, "right"), begins + SIZE)
    low = (keys & np.uint64(0xFFFFFFFF)).astype(">u4")
    for i, a, b in zip(full, begins, ends, strict=True):
        out[i] = low[a:b]
    return out


def likeness(a: set, b: set, size: int = SIZE) -> float:
    """The share of common names in the smallest of the union."""
    if not a and not b:
        return 1.0
    smallest = sorted(a | b)[:size]
    both = a & b
    return sum(x in both for x in smallest) / len(smallest)


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the next one's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


ROWS = (
    "part int, kind int, doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double, text string"
)
DONE, LAST, FIRST = range(3)


def _compared(ids, texts, prints, followers, next_prints, part) -> pd.DataFrame:
    """Rows of documents whose next ones are known."""
    changed = [edited(t, n) for t, n in zip(texts, followers, strict=True)]
    changed_prints = fingerprints(changed)
    sets = lambda found: [set(x.tolist()) for x in found]
    own, new, following = sets(prints), sets(changed_prints), sets(next_prints)
    return pd.DataFrame(
        {
            "part": part,
            "kind": DONE,
            "doc_id": pd.array(ids, dtype="Int64"),
            "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            "fingerprint": [x.tobytes() for x in prints],
            "edited_fingerprint": [x.tobytes() for x in changed_prints],
            "near_edited": [likeness(a, b) for a, b in zip(own, new, strict=True)],
            "near_next": [likeness(a, b) for a, b in zip(own, following, strict=True)],
            "text": None,
        }
    )


def _end(part: int, kind: int, i, text: str, found: np.ndarray) -> pd.DataFrame:
    """The first or last document of a part, for which the neighbouring part is needed."""
    row = {c.split()[0]: [None] for c in ROWS.split(", ")}
    row |= {"part": [part], "kind": [kind], "doc_id": pd.array([i], dtype="Int64"), "n_chars": [len(text)]}
    return pd.DataFrame(row | {"fingerprint": [found.tobytes()], "text": [text]})


def _number(value):
    return None if value is None or value != value else int(value)


def _in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of one part in order; each is compared when the next one has come."""
    part, held = TaskContext.get().partitionId(), None
    for batch in batches:
        ids, all_texts = [_number(i) for i in batch["doc_id"]], list(batch["text"])
        begin = 0
        while begin < len(ids):
            end, size = begin, 0
            while end < len(ids) and (end == begin or size + len(all_texts[end]) <= CHUNK):
                size += len(all_texts[end])
                end += 1
            texts = all_texts[begin:end]
            prints = fingerprints(texts)
            rows = list(zip(ids[begin:end], texts, prints, strict=True))
            begin = end
            if held is None:
                yield _end(part, FIRST, *rows[0])
            else:
                rows.insert(0, held)
            held = rows[-1]
            if len(rows) > 1:
                own_ids, own_texts, own_prints = (list(x) for x in zip(*rows, strict=True))
                yield _compared(own_ids[:-1], own_texts[:-1], own_prints[:-1], own_texts[1:], own_prints[1:], part)
    if held is not None:
        yield _end(part, LAST, *held)


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    prints = lambda column: [np.frombuffer(x, ">u4") for x in column]
    for b in batches:
        ids = [_number(i) for i in b["doc_id"]]
        if ids:
            own, following = prints(b["fingerprint"]), prints(b["next_fingerprint"])
            yield _compared(ids, list(b["text"]), own, list(b["next_text"]), following, 0)


def fingerprint_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all documents and of their edited texts, compared with the next document's.

    One shuffle orders the documents by ranges of ids; a task then goes through
    its range, holding a chunk of texts at a time. Only the first and the last
    document of each range are joined with those of the ranges beside it. Which
    range follows which is one number per range, held by the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Spark samples the keys on the driver to find the ranges: ids and digests, never texts.
    order = [F.col("doc_id").desc_nulls_last(), F.col("digest")]
    ranged = rows.withColumn("digest", F.md5("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    # Long ids with nulls would become doubles on the way to pandas; text does not.
    ranged = ranged.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = stored(ranged.mapInPandas(_in_order, ROWS), "fingerprints")
    parts = sorted(r["part"] for r in found.where(F.col("kind") == FIRST).select("part").collect())
    pairs = [(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)]
    follows = spark.createDataFrame(pairs, "part int, next_part int")
    heads = found.where(F.col("kind") == FIRST).select(
        F.col("part").alias("next_part"),
        F.col("text").alias("next_text"),
        F.col("fingerprint").alias("next_fingerprint"),
    )
    last = found.where(F.col("kind") == LAST).select(
        "part", F.col("doc_id").cast("string").alias("doc_id"), "text", "fingerprint"
    )
    last = last.join(follows, "part").join(heads, "next_part")
    ends = last.select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint").mapInPandas(_joined, ROWS)
    hexed = lambda c: F.lower(F.hex(c)).alias(c)
    return found.where(F.col("kind") == DONE).unionByName(ends).select(
        "doc_id", "n_chars", "edited_sha256", hexed("fingerprint"), hexed("edited_fingerprint"), "near_edited", "near_next"
    )
