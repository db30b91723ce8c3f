"""Targets by water-filling and the words taken, against plain Python."""

from __future__ import annotations

import random

from cellpulse.llm import mixing as m

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, target string"


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    rest, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = 2 * sizes[s]
            rest -= target[s]
        free -= over
    return target


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "x") for i, t, s in rows], SCHEMA)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        n = rng.choice([0, 1, 5, 40, 300])
        source = rng.choice(["a", "a", "a", "b", "é", "Z", "src10", "src2", None, "tiny" if i % 50 == 0 else "a"])
        rows.append((i if i % 20 else None, " \n"[i % 2].join(["w"] * n) if i % 30 else None, source))
    return rows + rows[:7]


def test_mix(spark):
    rows = random_rows(1)
    frame = docs(spark, rows)
    got = m.mix(frame).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = plain_targets(sizes)
    by_source = {(sizes[s], round(target[s], 6)): 0 for s in sizes}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_source[(r.source_size, round(r.target, 6))] += r.taken
    for (_, goal), taken in by_source.items():
        assert abs(taken - goal) <= 5  # rows of equal id share what is left
    again = m.mix(frame.repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_repetitions(spark):
    rows = [r for r in random_rows(2) if r[0] is not None]
    frame = docs(spark, rows)
    mixed = m.repeat(frame)
    assert mixed.columns == frame.columns
    taken = {}
    for r in mixed.collect():
        words = len(r.text.split())
        assert r.n_chars == len(r.text)
        taken[r.doc_id] = taken.get(r.doc_id, 0) + words
    wanted = {}
    for r in m.mix(frame).collect():
        wanted[r.doc_id] = wanted.get(r.doc_id, 0) + r.taken
    assert taken == {i: n for i, n in wanted.items() if n}


def test_empty(spark):
    empty = docs(spark, [])
    assert m.mix(empty).count() == 0
    assert m.repeat(empty).count() == 0
    assert [tuple(r) for r in m.mix(docs(spark, [(1, None, None), (2, "", "a")])).select("taken").collect()] == [(0,), (0,)]


def test_rows_without_ids_meet_their_target(spark):
    """One source, no ids, one long document: the cut falls inside the rows of equal id."""
    rows = [(None, f"w{i} " * (10_000 if i == 0 else 8), "en", "a", 0) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken = m.mix(docs).collect()
    assert abs(sum(r["taken"] for r in taken) - taken[0]["target"]) <= 1
    assert all(r["taken"] <= 2 * r["size"] for r in taken)
