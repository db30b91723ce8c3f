"""Local consistency, likeness, and the order of documents."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from cellpulse.llm import fingerprints as f

SCHEMA = "doc_id long, text string, lang string, part int, kind string"


def text(rng, n):
    return "".join(rng.choices("etaoin shrdlué\n", k=n))


def test_equal_texts_and_batches():
    rng = random.Random(1)
    texts = ["", "a", "aa", "a" * 5000, "ab" * 3000, "ab", "abc"] + [text(rng, rng.randrange(1, 3000)) for _ in range(60)]
    together = f.fingerprints(texts)
    for t, own in zip(texts, together, strict=True):
        assert (f.fingerprints([t])[0] == own).all()
        assert len(own) <= f.SIZE and (len(own) > 0) == bool(t)
        assert (np.diff(own.astype(np.int64)) > 0).all()
    assert len({x.tobytes() for x in together}) == len(set(texts))


def test_shared_passages_have_shared_names():
    rng = random.Random(2)
    passage = text(rng, 4000)
    sets = [set(x.tolist()) for x in f.fingerprints([text(rng, k) + passage for k in (1, 7, 50, 333)])]
    other = set(f.fingerprints([text(rng, 4000)])[0].tolist())
    for s in sets[1:]:
        assert f.likeness(sets[0], s) > 0.7
        assert f.likeness(other, s) < 0.1


def plain(rows):
    """What the contract says of each row, by brute force."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest()))
    out = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        t, following = t or "", following or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        own, new, nxt = f.fingerprints([t, edited, following])
        sets = [set(x.tolist()) for x in (own, new, nxt)]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(t), sha, own.tobytes().hex(), new.tobytes().hex(), f.likeness(sets[0], sets[1]), f.likeness(sets[0], sets[2])))
    return out


def test_table(spark):
    rng = random.Random(3)
    rows = [(i * 3, rng.choice([None, "", text(rng, rng.randrange(2000)), "é😀" * 20])) for i in range(200)]
    rows += [(2**62 + 1, text(rng, 60_000)), (9, "tie"), (9, "tie"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "en", 1, "x") for i, t in rows], SCHEMA)
    for own, wanted in ((docs.repartition(5), rows), (docs.where("doc_id = 3"), [r for r in rows if r[0] == 3]), (docs.limit(0), [])):
        got = [tuple(r) for r in f.fingerprint_table(own).collect()]
        assert sorted(got, key=str) == sorted(plain(wanted), key=str)
