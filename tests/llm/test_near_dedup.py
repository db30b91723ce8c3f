"""Near duplicates against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
import pytest

from cellpulse.llm import near_dedup as n

SCHEMA = "doc_id long, text string, sid string, node string"


def words_of(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))


def set_of(text):
    words = words_of(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def plain(rows):
    sets = [set_of(r[1]) for r in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    found = [(r[0], len(sets[i]), least.get(root(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]
    return sorted([(*f, f[0] == f[2]) for f in found], key=str)


def edited(words, draw, share):
    return [draw.choice(["zz", "yy", "xx"]) + str(draw.randrange(99)) if draw.random() < share else w for w in words]


def corpus(seed, groups=40, hot=150):
    """Groups of copies whose edits reach from none to more than the threshold, and one group of many."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for size in [hot, *(draw.randrange(1, 9) for _ in range(groups))]:
        base = [draw.choice(vocabulary) for _ in range(draw.choice([6, 30, 120, 200]) if size != hot else 140)]
        for _ in range(size):
            rows.append(" ".join(edited(base, draw, draw.choice([0, 0, 0.005, 0.02, 0.03, 0.06, 0.12]))))
    ids = list(range(len(rows)))
    draw.shuffle(ids)
    return [(i, t, "x", "y") for i, t in zip(ids, rows, strict=True)]


def result(spark, rows):
    found = n.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    assert result(spark, rows) == plain(rows)


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(n, "BLOCK", 7)
    monkeypatch.setattr(n, "STAR", 5)
    rows = corpus(3, groups=10)
    assert result(spark, rows) == plain(rows)


def test_links_between_chains_do_not_grow_with_members_buckets_or_blocks():
    """Near signatures in many buckets and blocks: each chain is joined once, not each member everywhere."""
    base = np.random.default_rng(6).integers(0, 1 << 16, n.PLACES).astype(np.uint16)
    rows = np.tile(base, (60, 1))
    rows[np.arange(60), np.arange(60)] += 1
    comp = np.maximum(np.arange(60) - 49, 0)  # a chain of 50 and ten of one
    groups = []
    for node in np.unique(keys := n.bucket_keys(rows).view(np.int64)):
        at = np.flatnonzero((keys == node).any(axis=1))
        own = np.where(at < 50, 1 + at % 5, 0)
        for high in range(6):
            of = (own == 0) | (own == high)
            groups.append(pd.DataFrame({"node": node, "low": 0, "high": high, "sid": at[of], "comp": comp[at[of]], "own": own[of], "signature": [r.tobytes() for r in rows[at[of]]]}))
    found = pd.concat(n._chain(iter([pd.concat(groups)])))
    label = comp.copy()
    for a, b in found.itertuples(index=False):
        label[label == label[a]] = label[b]
    assert len(set(label)) == 1
    assert len(found) < 2 * 60


def test_nulls_ties_and_short_texts(spark):
    rows = [
        (1, None, "x", "y"), (2, "", "x", "y"), (3, " \n\t", "x", "y"), (4, "one", "x", "y"), (5, "ONE", "x", "y"),
        (6, "one two", "x", "y"), (7, "one two three", "x", "y"), (8, "One\ntwo\x0bthree", "x", "y"), (8, "one two three", "x", "y"),
        (9, "ÄB", "x", "y"), (10, "äb", "x", "y"), (None, "a b c d e", "x", "y"), (12, "a b c d e", "x", "y"),
        (14, "same words here now " * 4000, "x", "y"), (13, "same words here now " * 3000, "x", "y"),
    ]
    got = result(spark, rows)
    expected = plain(rows)
    assert got == expected
    assert (None, 2, 12, False) in got


def test_empty_table(spark):
    assert result(spark, []) == []


def test_every_near_pair_shares_a_bucket():
    """The pigeonhole guarantee: any choice of at most DISTANCE symbols in error leaves one key the same."""
    draw = np.random.default_rng(5)
    for _ in range(300):
        a = draw.integers(0, 1 << 16, n.PLACES).astype(np.uint16)
        b = a.copy()
        at = draw.choice(n.PLACES, n.DISTANCE, replace=False)
        b[at] += 1
        keys = n.bucket_keys(np.stack((a, b)))
        assert keys.shape[1] == n.PLACES
        assert (keys[0] == keys[1]).any()


def test_signature_distance_follows_the_similarity():
    draw = random.Random(9)
    apart = []
    for _ in range(200):
        base = [f"w{draw.randrange(10**6)}" for _ in range(203)]
        other = base[:180] + [f"v{draw.randrange(10**6)}" for _ in range(23)]  # 177 of 223 shingles
        _, found = n.set_sizes_and_signatures([" ".join(base).encode(), " ".join(other).encode()])
        apart.append(int((found[0] != found[1]).sum()))
    assert max(apart) <= n.DISTANCE
    assert abs(np.mean(apart) / n.PLACES - (1 - 177 / 223)) < 0.02
