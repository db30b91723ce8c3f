"""Collocations against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from cellpulse.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, rank string"


def plain(rows, least, top=2000):
    found = []
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang in {r[2] or "und" for r in rows}:
        counts, n = Counter(), 0
        for _, text, own, *_ in rows:
            if (own or "und") != lang:
                continue
            for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
                words = re.findall("[^ \t]+", piece)
                n += len(words)
                for k in range(1, 6):
                    counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
        cand = {p: f for p, f in counts.items() if len(p) > 1 and f >= least}
        covered = Counter()
        for p, f in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    covered[p[i : i + m]] = max(covered[p[i : i + m]], f)
        own = []
        for p, a in cand.items():
            if covered[p] >= a:
                continue
            score, k = min((1000 * a * n // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            own.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(found)


def rows_of(seed, n=120):
    draw = random.Random(seed)
    words = ["a", "B", "ça", "dd", "EE", "f g", "ÄÖ", "x1"]
    texts = ["".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ", ", ".\n", "!"]) for _ in range(draw.randrange(40))) for _ in range(n)]
    rows = [(i, t, draw.choice(["en", "de", None]), "x") for i, t in enumerate(texts)]
    return rows + [(1, None, "en", "x"), (None, "", None, "x"), (5, "A b " * 3000, "en", "x"), *rows[:10], (7, ". ,", "xx", "x")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_counts(spark, monkeypatch, seed):
    rows = rows_of(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = c.collocations(docs, min_count=4)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain(rows, 4)
    assert sorted(map(tuple, c.collocations(docs, min_count=4, top=3).collect())) == plain(rows, 4, 3)


def test_empty_table(spark):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_summary_keeps_every_frequent_key_and_stays_small():
    draw = np.random.default_rng(3)
    stream = np.concatenate((draw.integers(0, 1 << 60, 60_000, dtype=np.uint64), np.repeat(np.arange(50, dtype=np.uint64), 25)))
    draw.shuffle(stream)
    capacity = 3 * len(stream) // (2 * 25)
    summary = c.Summary(25, capacity)
    for part in np.array_split(stream, 500):
        keys, counts = np.unique(part, return_counts=True)
        summary.add(keys, counts)
    kept = summary.survivors()
    assert set(range(50)) <= set(kept.tolist())
    assert summary.lost < 25
    assert summary.capacity == capacity
    assert len(kept) < capacity


def test_a_summary_grows_rather_than_lose_too_much():
    summary = c.Summary(10, 4)
    for _ in range(10):
        summary.add(np.arange(40, dtype=np.uint64), np.ones(40, np.int64))
    assert set(summary.survivors().tolist()) == set(range(40))


def test_long_text_is_cut_between_pieces(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(c, "CHUNK_BYTES", 64)
    text = b"one two three. " * 40 + b"endless " * 30
    parts = [d for _, d in c._stretches(iter([pd.DataFrame({"lang": ["en", "en"], "text": [text, b"Last"]})]))]
    assert b"".join(parts).split() == (text.translate(c._LOWER) + b"last").split() or len(parts) > 5
    total = Counter()
    for d in parts:
        for piece in d.split(b"\n"):
            total.update(piece.split())
    assert total == Counter({b"one": 40, b"two": 40, b"three": 40, b"endless": 30, b"last": 1})


def test_words_hash_alike_wherever_they_lie():
    words = c.Words(b"abc  abd abc\nabc abc", both=True)
    for hashes in words.hashes:
        assert len(set(hashes.tolist())) == 2
        assert hashes[0] == hashes[2] == hashes[3]
    pairs = list(words.phrases())[1]
    assert pairs[0].tolist() == [0, 1, 3]
