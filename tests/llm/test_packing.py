"""Ids against the tokenizer itself, and sequences without holes."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from cellpulse.llm import packing as p
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, ids int, df string"


def texts():
    rng = random.Random(1)
    bits = ["hello", "World", "it's", "don't", "'ll", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "é", "é", "ß", "İ", "漢字",
            "😀", "123", "1²", "½", ".", "...", "<|endoftext|>", "<|", "|>", "_", "a_b", "ﬁ", "ͅ", "﻿", "µ", "ÀÉ"]
    return ["", " "] + ["".join(rng.choices(bits, k=rng.randrange(14))) for _ in range(1500)]


def expected(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [p.CLOSING]


def test_ids():
    tokenizer, encoder = Tokenizer.from_file(PATH), p.Encoder(PATH)
    for t in texts():
        assert np.frombuffer(encoder.encode(t), "<u2").tolist() == expected(tokenizer, t), repr(t)


def test_pack_uses_neighbours():
    rng = random.Random(2)
    topics = [rng.sample(range(10, 5000), 40) for _ in range(6)]
    docs = [np.array(rng.choices(topics[i % 6], k=300), "<u2") for i in range(120)]
    df = np.zeros(1 << 16)
    for d in docs:
        df[np.unique(d)] += 1
    idf = np.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
    sequences = p.pack(docs, idf, 300.0)
    same = [len({d % 6 for d, _, _ in s}) == 1 for s in sequences if len(s) > 3]
    assert sum(same) >= 0.7 * len(same)


def check(rows, texts_by_row):
    """Every id in one piece, and sequences gapless and full or a power of two."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        total = 0
        for r in own:
            assert r.offset == total and r.length > 0
            total += r.length
        assert total <= p.WINDOW and total & (total - 1) == 0
    docs = {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
    assert set(docs) == {i for i, _ in texts_by_row}
    tokenizer = Tokenizer.from_file(PATH)
    for i, text in texts_by_row:
        ids = expected(tokenizer, text)
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_table(spark):
    rng = random.Random(3)
    own = [None, "", "x " * 30_000] + [" ".join(rng.choices(["the", "hinting", "Eau", "zuie."], k=rng.randrange(900))) for _ in range(300)]
    rows = list(enumerate(own))
    docs = spark.createDataFrame([(i, t, "en", 1, "x") for i, t in rows], SCHEMA)
    check(p.pack_documents(docs, PATH).collect(), rows)
    twice = p.pack_documents(docs.union(docs).union(docs.selectExpr("null as doc_id", "text", "lang", "ids", "df")), PATH)
    ids = sum(r.length for r in twice.collect())
    tokenizer = Tokenizer.from_file(PATH)
    assert ids == 3 * sum(len(expected(tokenizer, t)) for t in own)
    assert p.pack_documents(docs.limit(0), PATH).count() == 0
    whole = p.pack_documents(docs, PATH, with_ids=True).collect()
    assert all(zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32 for r in whole)


def test_a_worker_remembers_few_pieces():
    """A rare word is a piece of its own; remembered twice, it doubled what a worker holds."""
    tokenizer, encoder = Tokenizer.from_file(PATH), p.Encoder(PATH)
    words = [f"{chr(97 + i % 26)}{'qxzj'[i % 4]}{''.join(chr(97 + int(d)) for d in str(i))}" for i in range(60_000)]
    for text in (" ".join(words), " ".join(reversed(words))):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == expected(tokenizer, text)
    assert len(encoder.pieces) <= 1 << 15


def test_a_word_is_remembered_once_whatever_its_case_and_marks():
    """Every form of a word was remembered and merged for itself: 397 CPU seconds a GB."""
    encoder, asked = p.Encoder(PATH), []

    class Model:
        def tokenize(self, piece, own=encoder.model):
            asked.append(piece)
            return own.tokenize(piece)

    encoder.model = Model()
    a = "abcdefghijklmnopqrstuvwxyz"
    words = [f"{a[i % 26]}qé{a[i // 26 % 26]}{a[i // 676 % 26]}{a[i // 17576]}" for i in range(40_000)]
    forms = [words, [w.capitalize() + "," for w in words], [w.upper() + "." for w in words], [f"({w})" for w in words]]
    tokenizer = Tokenizer.from_file(PATH)
    for own in forms:
        assert np.frombuffer(encoder.encode(" ".join(own)), "<u2").tolist() == expected(tokenizer, " ".join(own))
    assert len(encoder) == len(asked) == len(words) + len([",", ".", "(", ")"])


def test_texts_of_a_batch(monkeypatch):
    """Texts that are divided together do not touch, odd words stay whole, and the batch may be cut anywhere."""
    own = ["'", "s", "'s", "'", "re ", "ve", "<", "|x", None, "漢", "́e", "<|endoftext|>", "5's''s", "it's'T\t'LL", "a\x1cb é́", *texts()]
    random.Random(4).shuffle(own)
    tokenizer, encoder = Tokenizer.from_file(PATH), p.Encoder(PATH)
    right = [expected(tokenizer, t) for t in own]
    for limit in (p.TEXT_BYTES, 1000, 1):
        monkeypatch.setattr(p, "TEXT_BYTES", limit)
        monkeypatch.setattr(p, "MEMO", limit)
        assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode_all(own)] == right
    assert encoder.encode_all([]) == []


def test_frequencies(spark):
    own = [None, "", "a a b", "b c", "é b" * 50]
    docs = spark.createDataFrame([(i, t, "en", 1, "x") for i, t in enumerate(own)], SCHEMA)
    df, n, mean = p.statistics(p.tokenized(docs, PATH))
    tokenizer = Tokenizer.from_file(PATH)
    right = np.zeros(1 << 16, np.int64)
    for t in own:
        right[np.unique(expected(tokenizer, t))] += 1
    assert (df == right).all() and n == len(own)
    assert mean == sum(len(expected(tokenizer, t)) for t in own) / n
