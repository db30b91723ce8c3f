"""Links and classes against all pairs of a small table, and the parts of the method."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from cellpulse.llm import ngram_join as n

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, class_id string, node int"


def words(rng, k):
    return [f"w{rng.randrange(5000)}" for _ in range(k)]


def changed(rng, base, k):
    out = list(base)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a", "a", " a ", "a b", "one two three four five", "one two  three four\nfive"]
    for _ in range(25):
        base = words(rng, rng.randrange(8, 300))
        texts += [" ".join(changed(rng, base, rng.randrange(0, max(1, len(base) // 25)))) for _ in range(rng.randrange(1, 6))]
    base = words(rng, 200)
    texts += [" ".join(changed(rng, base, 2)) for _ in range(60)] + [" ".join(base)] * 30
    shared = words(rng, 60)
    texts += [" ".join(words(rng, 20) + shared + words(rng, 30)) for _ in range(30)]
    texts += [" ".join(words(rng, 40_000))]
    return texts


def shingle_set(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else None


def all_pairs(rows):
    """Class and number of linked other texts of every row."""
    keys = {}
    for i, t in rows:
        s = shingle_set(t)
        if s:
            keys.setdefault(tuple(t.split()), (s, []))[1].append(i)
    items = list(keys.values())
    parent, links = list(range(len(items))), [0] * len(items)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(items)):
        for b in range(a):
            x, y = items[a][0], items[b][0]
            both = len(x & y)
            if 5 * both >= 4 * (len(x) + len(y) - both):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    smallest = {}
    for k, (_, ids) in enumerate(items):
        smallest[find(k)] = min([smallest.get(find(k), 10**9), *(i for i in ids if i is not None)])
    found = [(i, smallest[find(k)], links[k], len(ids)) for k, (_, ids) in enumerate(items) for i in ids]
    return sorted(found + [(i, i, 0, 1) for i, t in rows if not shingle_set(t)], key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 1) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("leaf, block", [(200, 512), (8, 16)])
def test_join(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(n, "LEAF", leaf)
    monkeypatch.setattr(n, "BLOCK", block)
    rows = list(enumerate(corpus(1)))
    random.Random(2).shuffle(rows)
    rows += rows[:5] + [(None, rows[0][1])]
    docs = frame(spark, rows)
    got = sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in n.classes(docs).collect()), key=str)
    assert got == all_pairs(rows)


def test_one_of_each(spark):
    rows = list(enumerate(corpus(3)))
    docs = frame(spark, rows + rows[3:12])
    kept = n.one_of_each(docs)
    assert kept.columns == docs.columns
    stays = {(i, c) for i, c, _, _ in all_pairs(rows) if i == c and shingle_set(rows[i][1])}
    got = [r.doc_id for r in kept.collect() if shingle_set(r.text)]
    assert sorted(got) == sorted(i for i, _ in stays)
    assert n.one_of_each(docs.limit(0)).count() == 0 and n.classes(docs.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    rng = random.Random(4)
    base = words(rng, 400)
    texts = [" ".join(base)] + [" ".join(changed(rng, base, k)) for k in (1, 5, 20)]
    found = n.signatures(texts)
    sets = [shingle_set(t) for t in texts]
    for k in range(1, 4):
        exact = len(sets[0] & sets[k]) / len(sets[0] | sets[k])
        assert abs((found[0] == found[k]).mean() - exact) < 0.15


def test_blocks_count_every_pair_once():
    rng = random.Random(5)
    base = words(rng, 100)
    texts = [" ".join(changed(rng, base, 2)) for _ in range(40)]
    whole, _ = n.exact_links(texts)
    side = np.arange(40) % 2
    parts = [n.exact_links([t for t, s in zip(texts, side, strict=True) if s == k])[0] for k in (0, 1)]
    across, _ = n.exact_links(texts, side)
    assert whole == [parts[i % 2][i // 2] + across[i] for i in range(40)]


def test_pairs_at_the_threshold_meet_below_all_splits():
    rng = np.random.default_rng(6)
    one = rng.integers(0, 1 << 16, (400, n.PLACES), np.uint16)
    other = np.where(rng.random(one.shape) < n.MIN_JACCARD, one, rng.integers(0, 1 << 16, one.shape, np.uint16))
    runs = n.runs_for(n.RECALL)
    places = n.root_places(runs, n.MIN_JACCARD)
    run, place = (np.array(x) for x in zip(*places, strict=True))
    met = []
    for side in (one, other):
        nodes = n._node(run.astype(np.uint64), place, side[:, place])
        node, keys = nodes.ravel(), np.repeat(np.arange(len(side)), len(places))
        for _ in range(n.START):
            node, _, keys = n._below(node, keys, side)
        rows = pd.DataFrame({"node": node.view(np.int64), "copy_key": keys})
        for _ in range(n.ROUNDS):
            rows["signature"] = [side[i].tobytes() for i in rows["copy_key"]]
            rows = pd.concat(n._split(iter([rows])))
            rows = rows[rows["depth"] == n.LEVELS][["node", "copy_key"]]
        met.append(set(zip(rows["node"], rows["copy_key"], strict=True)))
    missed = 400 - len({i for _, i in met[0] & met[1]})
    assert n.recall(runs, n.START + n.ROUNDS * n.LEVELS) >= n.RECALL >= 0.9998 and missed <= 1
    assert n.runs_for(0.9) < runs < n.runs_for(0.99988)


def test_every_node_chooses_a_place():
    limit = np.uint64(int(2.0**64 / (n.MIN_JACCARD * n.PLACES)))
    chosen = n._chosen(n._constants(9, 5000), n._constants(77, n.PLACES), limit)
    assert chosen.any(axis=1).all() and 1.45 < chosen.sum(axis=1).mean() < 1.62


def test_a_worker_remembers_few_words():
    """Word hashes are quickly made again, and stay in a worker's memory through all later stages."""
    text = " ".join(f"w{i}" for i in range(200_000))
    first, _ = n.shingles([text])
    again, _ = n.shingles([text])
    assert (first == again).all()
    assert len(n._words) <= 1 << 17
