"""Measures against a plain Python count, and the verdict of hosts."""

from __future__ import annotations

import random
import re
from collections import Counter

from cellpulse.llm import quality_rules as q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, host string"


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def frame(spark, texts, sources=None):
    sources = sources or ["a"] * len(texts)
    return spark.createDataFrame(
        [(i, t, "en", s, 0, "x", "y") for i, (t, s) in enumerate(zip(texts, sources, strict=True))], SCHEMA
    )


def test_measures(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t", "a", "é\x1cb c", "a b c d e a b c d e", "x\nx\n\n x\nx \r\n", "# $ %%"]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += ["\n".join(rng.choice(["a b", "c", "", "d e f"]) for _ in range(9)) for _ in range(10)]
    texts.append(" ".join(str(rng.randrange(3000)) for _ in range(30_000)) * 2)
    got = {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in q.verdicts(frame(spark, texts)).collect()
    }
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_hosts(spark):
    clean = "one two three four five six seven eight nine ten eleven"
    junk = clean + " ### $$$ %%% &&& ***"
    texts, sources = [], []
    for host, n_clean, n_junk in (("good", 60, 3), ("bad", 2, 58), (None, 20, 0), ("tiny", 0, 1)):
        texts += [clean] * n_clean + [junk] * n_junk
        sources += [host] * (n_clean + n_junk)
    rows = q.verdicts(frame(spark, texts, sources)).collect()
    kept = {r.doc_id for r in rows if r.kept}
    gone = {i for i, (t, s) in enumerate(zip(texts, sources, strict=True)) if t == junk and s in ("bad",)}
    assert len(rows) == len(texts)
    assert not kept & gone
    assert all(i in kept for i, t in enumerate(texts) if t == clean)
    assert all(i in kept for i, (t, s) in enumerate(zip(texts, sources, strict=True)) if s == "good")


def test_keep_returns_the_columns(spark):
    docs = frame(spark, ["short", "one two three four five six seven eight nine ten"])
    kept = q.keep(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [1]
    assert q.keep(docs.limit(0)).count() == 0
    assert q.verdicts(docs.limit(0)).count() == 0
    again = q.verdicts(docs.union(docs)).collect()
    assert sorted(r.doc_id for r in again) == [0, 0, 1, 1]
