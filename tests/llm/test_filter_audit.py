"""The audit against a plain run of all orders."""

from __future__ import annotations

import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from cellpulse.llm import filter_audit as f

SCHEMA = "doc_id long, text string, source string, kind string, before string"


def plain(rows, labels):
    texts = [r[1] or "" for r in rows]
    fails = []
    for r, t in zip(rows, texts, strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append(
            {
                "A": len(w) < 50,
                "B": 100 * len(set(w)) < 65 * len(w),
                "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                "D": bool(re.search("[#$%&*|]", t)),
                "E": r[0] is not None and any(o[0] is not None and o[0] < r[0] and (o[1] or "") == t for o in rows),
            }
        )
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    found = {}
    for part in {r[2] or "" for r in rows}:
        own = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive = set(own)
            for step, x in enumerate(order, 1):
                out = {i for i in alive if fails[i][x]}
                gone = sum(fails[i][x] for i in own if i not in alive)
                alive -= out
                shapley[x] += len(out)
                only = sum(fails[i][x] and sum(fails[i].values()) == 1 for i in own)
                lost = [sum(rows[i][0] in s for i in out) for s in (good, toxic)]
                found[part, "".join(order), step] = [len(alive), len(out), gone, only, *lost]
        for (p, order, step), row in found.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return found


def rows_of(seed, n=160):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = [draw.choice(["alpha", "Beta", "GAMMA"]) + str(draw.randrange(draw.choice([5, 500]))) for _ in range(draw.choice([0, 20, 49, 50, 80]))]
        if draw.random() < 0.2:
            words.append(draw.choice("#$%&*|"))
        rows.append((i, draw.choice([" ", "\n"]).join(words), draw.choice(["s1", "s1", "s2", None, ""]), "k", "b"))
    rows += [(n + i, draw.choice(rows[:20])[1], "s2", "k", "b") for i in range(40)]
    rows += [rows[3], rows[3], (3, "other " * 60, "s1", "k", "b"), (None, rows[5][1], "s1", "k", "b"), (None, None, "s3", "k", "b")]
    rows += [(900, None, None, "k", "b"), (901, "", "s4", "k", "b"), (902, "X" * 200_000, "s4", "k", "b")]
    labels = [(draw.randrange(n + 40), draw.choice([0, 1]), draw.choice([0, 1, None])) for _ in range(120)] + [(None, 1, 1)]
    return rows, labels


def test_against_all_orders(spark):
    rows, labels = rows_of(4)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = f.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r[:3]): list(r[3:]) for r in found.collect()} == plain(rows, labels)


def test_no_failures_and_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    fine = [(1, " ".join(f"w{i}" for i in range(60)), "s", "k", "b")]
    found = f.audit(spark.createDataFrame(fine, SCHEMA), labels).collect()
    assert len(found) == 600 and {tuple(r[3:]) for r in found} == {(1, 0, 0, 0, 0, 0, 0)}
    assert f.audit(spark.createDataFrame([], SCHEMA), labels).collect() == []


def test_ids_are_divided_by_semi_and_anti_joins(spark):
    rows, labels = rows_of(5, 60)
    facts = f.measured(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "source")
    ids = facts.select("part", *f.KEYS, F.lit("").alias("failed"))
    divided = f.divide(ids, "D", f.failing(facts)["D"].select(*f.KEYS))
    plan = divided._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" in plan
    found = {r["failed"]: r["n"] for r in divided.groupBy("failed").agg(F.count("*").alias("n")).collect()}
    assert found["D"] == sum(bool(re.search("[#$%&*|]", r[1] or "")) for r in rows) and sum(found.values()) == len(rows)
