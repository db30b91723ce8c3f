"""Folding, escaping and reading back."""

from __future__ import annotations

import hashlib
import random

from cellpulse.llm import chat_format as c
from pyspark.sql import functions as F

LOG = "conv_id long, seq long, message long, kind string, role string, text string, formatted string"


def folded(spark, events):
    log = spark.createDataFrame([(*e, "clash") for e in events], LOG)
    return {(r.conv_id, r.message): (r.role, r.text) for r in c.fold(log).collect()}


def test_fold(spark):
    events = [
        (1, 0, 0, "message", "user", "hi"),
        (1, 1, 1, "message", "assistant", None),
        (1, 3, 1, "delta", None, "wor"),
        (1, 2, 1, "delta", None, "hello "),
        (1, 4, 1, "delta", None, "ld"),
        (1, 4, 1, "delta", None, "ld"),  # a repeated event counts once
        (1, 5, 2, "message", "user", "next"),
        (1, 6, 1, "regenerate", None, None),  # the turn behind it goes
        (1, 7, 1, "delta", None, "again"),
        (1, 8, 3, "message", "user", "more"),
        (1, 9, 0, "edit", None, "hi there"),
        (1, 10, 0, "unknown", "user", "x"),
        (None, None, 0, "message", None, "no conversation"),
        (2, 0, 0, "delta", None, "only a piece"),
    ]
    assert folded(spark, events) == {
        (1, 0): ("user", "hi there"),
        (1, 1): ("assistant", "again"),
        (1, 3): ("user", "more"),
        (None, 0): ("", "no conversation"),
        (2, 0): ("", "only a piece"),
    }


def test_escape_is_reversible(spark):
    rng = random.Random(4)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "\\", "<", "[", "s>", " ", "é\n", "/"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(9))) for _ in range(2000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", c.escape(F.col("t")))
    for row in frame.withColumn("u", c.unescape(F.col("e"))).collect():
        assert row.u == row.t
        assert not any(control in row.e for control in parts[:8])


def test_digests(spark):
    rng = random.Random(6)
    bits = ["</s>", "[INST]", "[/ROLE]", "a", "é", "\n", "\\", "<"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "system", "tool", "[/ROLE]", None])
            rows.append((conv, turn, role, rng.choice([None, "".join(rng.choices(bits, k=6))])))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in c.digests(c.render(c.fold(c.log_of_turns(frame)))).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = [(role or "", text or "") for i, _, role, text in rows if i == conv]
        loss = "".join(t for role, t in own if role == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert r.n_turns == len(own)
        assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in own))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert c.digests(c.render(c.fold(c.log_of_turns(frame.limit(0))))).count() == 0


def test_a_log_has_all_kinds_of_events_and_keeps_repeated_rows(spark):
    text = "a long answer with </s> and [INST] in it " * 60
    rows = [(i, t, role, f"{text}{i}") for i in range(40) for t, role in enumerate(["user", "assistant", "user"])]
    rows += [(1, 1, "assistant", "yes"), (1, 1, "assistant", "yes"), (1, 1, None, None), (2, None, "user", "when"), (3, 1, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = c.log_of_turns(frame)
    kinds = {r["kind"]: r["n"] for r in log.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert set(kinds) == set(c.KINDS) and kinds["delta"] > 40 * 50 and kinds["regenerate"] > 3 and kinds["edit"] > 3
    got = {r.conv_id: r for r in c.digests(c.render(c.fold(log))).collect()}
    for conv, r in got.items():
        own = sorted((-1 if t is None else t, role or "", text or "") for i, t, role, text in rows if i == conv)
        loss = "".join(t for _, role, t in own if role == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[1].n_turns == 6


def test_a_very_long_text_is_streamed_in_few_pieces(spark):
    frame = spark.createDataFrame([(1, 0, "assistant", "é" * 300_000)], "conv_id long, turn long, role string, text string")
    log = c.log_of_turns(frame)
    assert log.count() <= c.EVENTS
    assert c.digests(c.render(c.fold(log))).first().loss_chars == 300_000
