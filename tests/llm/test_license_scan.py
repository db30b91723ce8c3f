"""Cosines by brute force, and inheritance from directories."""

from __future__ import annotations

import math
import re
from collections import Counter

from cellpulse.llm import license_scan as m
from cellpulse.llm.common import attach, stored

FILES = [
    (1, "a/LICENSE", "Released under the MIT License."),
    (2, "a/b/x.txt", "prose without any notice"),
    (3, "a/b/c/y.txt", None),
    (4, "a/b/LICENSE.md", "Some words.\nLicensed under the Apache License, Version 2.0. More words."),
    (5, "a/b/z.txt", "This work is licensed under the GNU General Public License, version 3."),
    (6, "d/q.txt", "a public house with a general in it"),
    (7, None, "Licensed under CC BY-NC 4.0."),
    (8, "top.txt", ""),
    (9, "a/deep/er/w.txt", "the the the"),
    (9, "a/deep/er/w.txt", "the the the"),
]
SCHEMA = "doc_id long, path string, text string, license string, term int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_scan(spark):
    got = {r.doc_id: (r.license, r.origin, r.inherited_from) for r in m.license_scan(frame(spark, FILES)).collect()}
    assert got == {
        1: ("MIT", "stated", None),
        2: ("Apache-2.0", "inherited", "a/b"),
        3: ("Apache-2.0", "inherited", "a/b"),
        4: ("Apache-2.0", "stated", None),
        5: ("GPL-3.0", "stated", None),
        6: (None, "none", None),
        7: (None, "none", None),
        8: (None, "none", None),
        9: ("MIT", "inherited", "a"),
    }
    assert m.license_scan(frame(spark, FILES)).count() == len(FILES)
    assert m.license_scan(frame(spark, [])).count() == 0


def test_cosines(spark):
    found = m.statements(frame(spark, FILES), m.TEMPLATES)
    anchors = set(m.template_terms(m.TEMPLATES))
    pieces = []
    for _, path, text in set(FILES):
        for s in re.split(m.STATEMENTS, text or "") if path else []:
            if anchors & set(re.findall("[a-z0-9]+", s.lower())):
                pieces.append((path, Counter(m.terms_in(s))))
    df = Counter(t for _, c in pieces for t in c)
    idf = lambda t: math.log((1 + len(pieces)) / (1 + df[t])) + 1
    vector = lambda c: {t: k * idf(t) for t, k in c.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    wanted = []
    for path, c in pieces:
        v = vector(c)
        for name, text in m.TEMPLATES.items():
            w = vector(Counter(m.terms_in(text)))
            if set(v) & set(w):
                wanted.append((path, name, round(sum(v[t] * w.get(t, 0) for t in v) / norm(v) / norm(w), 6)))
    got = [(r.path, r.license, round(r.cosine, 6)) for r in m.cosines(found, m.TEMPLATES).collect()]
    assert sorted(got) == sorted(wanted)


def broadcast_rows(df) -> list[int]:
    """Rows of each table that a run of ``df`` sends through the driver."""
    df.collect()
    sent, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "BroadcastExchangeExec":
            sent.append(plan.longMetric("numOutputRows").value())
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return sent


def test_only_tables_of_the_templates_are_broadcast(spark, monkeypatch):
    # Every folder has a license file, every such file a word of its own.
    n = 100
    files = [(i, f"top/{i}/LICENSE", f"Released under the MIT License.\nMIT x{i}") for i in range(n)]
    files += [(n + i, f"top/{i}/y.txt", "prose") for i in range(n)]
    sent = {}

    def watched(df, label):
        sent[label] = broadcast_rows(df)
        return stored(df, label)

    monkeypatch.setattr(m, "stored", watched)
    found = m.license_scan(frame(spark, files))
    sent["result"] = broadcast_rows(found)
    assert len(sent) == 5
    # A row for each template and term.
    most = sum(len(m.terms_in(text)) for text in m.TEMPLATES.values())
    assert most < n and max(x for rows in sent.values() for x in [0, *rows]) <= most, sent
    got = [(r.doc_id, r.license, r.origin, r.inherited_from) for r in found.collect()]
    wanted = [(i, "MIT", "stated", None) for i in range(n)] + [(n + i, "MIT", "inherited", f"top/{i}") for i in range(n)]
    assert sorted(got) == wanted


def test_attach(spark):
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(["a"] * 40 + [None, "b", "c"])], "i int, k string")
    few = stored(spark.createDataFrame([("a", 1), (None, 2), ("c", 3), ("c", 4)], "of string, x int"), "few")
    got = attach(rows, few, "k", "of", "i")
    assert broadcast_rows(got) == []
    wanted = [(i, "a", "a", 1) for i in range(40)] + [(40, None, None, 2), (41, "b", None, None), (42, "c", "c", 3), (42, "c", "c", 4)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)
