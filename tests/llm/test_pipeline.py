"""Every stage against a plain version of it, on what the stage before kept."""

from __future__ import annotations

import random
import re

import corpus_pipeline
from cellpulse.llm import secret_scan
from cellpulse.llm.common import stored
from test_mixing import plain_targets
from test_ngram_join import all_pairs, changed, words
from test_packing import check
from test_quality_rules import plain as measures
from test_secret_scan import plain as spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    texts = [None, "", "too short", "a b c d e " * 20]
    for _ in range(60):
        base = words(rng, rng.randrange(12, 200))
        texts += [" ".join(changed(rng, base, rng.randrange(3))) for _ in range(rng.randrange(1, 4))]
    texts += [" ".join(words(rng, 30)) + f"\ntoken = \"{rng.getrandbits(160):040x}\" " + " ".join(words(rng, 5)) for _ in range(20)]
    return [(i, t, "en", rng.choice(["a", "b", "c", "d"]), len(t or "")) for i, t in enumerate(texts)]


def test_stages(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), name.replace(" ", "_"))
        results.append(docs.collect())
    quality, single, clean, mix, packed = results

    def good(text):
        m = measures(text)
        return m[0] >= 10 and 100 * m[4] <= 20 * m[0]

    kept = [r for r in rows if good(r[1])]
    assert sorted(tuple(r) for r in quality) == kept
    alone = {i for i, c, _, _ in all_pairs([(r[0], r[1]) for r in kept]) if i == c}
    assert sorted(tuple(r) for r in single) == [r for r in kept if r[0] in alone]
    by_id = {r.doc_id: r for r in clean}
    assert set(by_id) == alone
    for r in single:
        text, found = r.text, spans(r.text)
        if not found:
            assert by_id[r.doc_id].text == text
            continue
        values = re.findall("[0-9a-f]{40}", text)
        assert values and not any(v in by_id[r.doc_id].text for v in values)
        assert secret_scan.MARK in by_id[r.doc_id].text and by_id[r.doc_id].n_chars == len(by_id[r.doc_id].text)
    sizes, taken = {}, {}
    for r in clean:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in mix:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
        assert by_id[r.doc_id].text.startswith(r.text)
    for s, goal in plain_targets(sizes).items():
        assert abs(taken[s] - goal) <= 1
    numbered = [(k, r.text) for k, r in enumerate(mix)]
    pieces = corpus_pipeline.pack_sequences(spark, spark.createDataFrame(numbered, "doc_id long, text string"), "")
    check(pieces.collect(), numbered)
    assert sum(r.length for r in packed) == sum(r.length for r in pieces.collect())
    assert corpus_pipeline.STAGES[0][1](spark, spark.createDataFrame([], SCHEMA), "").count() == 0


def test_long_texts_go_to_python_in_small_batches(spark):
    rows = spark.createDataFrame([(i, "word " * 1000, "en", "a", 5000) for i in range(4000)], SCHEMA).coalesce(1)
    corpus_pipeline.STAGES[0][1](spark, rows.limit(0), "")
    sizes = rows.select("text").mapInPandas(lambda batches: (b.assign(n=b["text"].str.len().sum())[:1][["n"]] for b in batches), "n long")
    assert max(r.n for r in sizes.collect()) < 8 << 20
