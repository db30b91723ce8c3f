"""Counts against a public tokenizer over the same vocabulary, and ties by brute force."""

from __future__ import annotations

import random
from functools import cache

import public_tokenizers
import pytest
from tokenizers import Tokenizer, decoders, models, pre_tokenizers

from cellpulse.llm import token_counts as t

PATH = public_tokenizers.path("piece_bpe_32k.model")


@cache
def ours():
    return t.Counter(t.sentencepiece_pieces(PATH))


def tokenizer_of(pieces):
    vocabulary = [("<unk>", 0.0)] + [(f"<0x{b:02X}>", 0.0) for b in range(256)] + pieces
    found = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    found.pre_tokenizer = pre_tokenizers.Metaspace(replacement=t.MARK, prepend_scheme="always", split=True)
    found.decoder = decoders.ByteFallback()
    return found


def texts():
    rng = random.Random(3)
    some = ["", " ", "  ", "a", " a", "a ", "hello world", "x\ny\t z", "éèß ñ", "漢字 テスト", "😀😀 b", "▁ a", "a▁b"]
    some += ["".join(rng.choices("abcdefghin et", k=rng.randrange(80))) for _ in range(200)]
    some += ["".join(rng.choices("eéü ñ漢😀\n.,", k=rng.randrange(40))) for _ in range(100)]
    some.append("".join(rng.choices("thenga ", k=50_000)))
    some.append("n" * 5000)
    return some


def test_counts_of_public_tokenizer():
    # Scores of a merge list are whole numbers, so that many divisions tie; byte pieces are no matches of texts.
    theirs = tokenizer_of(t.sentencepiece_pieces(PATH))
    for text in texts():
        if t.MARK not in text and "<0x" not in text:
            assert t.count_text(ours(), text)[0] == len(theirs.encode(text).ids), text[:60]


@pytest.mark.parametrize("seed", range(30))
def test_ties(seed):
    """Small vocabularies with few different scores."""
    rng = random.Random(seed)
    pieces = {"".join(rng.choices("ab" + t.MARK, k=rng.randrange(1, 4))) for _ in range(8)}
    vocabulary = [(p, -float(rng.randrange(1, 4))) for p in sorted(pieces)]
    counter, theirs = t.Counter(vocabulary), tokenizer_of(vocabulary)
    # The tokenizer takes the lowest score from its whole vocabulary.
    for _ in range(50):
        text = "".join(rng.choices("abc ", k=rng.randrange(12)))
        assert t.count_text(counter, text)[0] == len(theirs.encode(text).ids), (vocabulary, text)


def test_table(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "hello"), (2, None), (2**62 + 1, "")]
    docs = spark.createDataFrame([(i, x, 9, 1.5) for i, x in rows], "doc_id long, text string, n_tokens int, score float")
    got = {(r.doc_id, r.n_tokens) for r in t.token_counts(docs, PATH).collect()}
    assert got == {(i, t.count_text(ours(), x)[0]) for i, x in rows}
    assert t.token_counts(docs.limit(0), PATH).count() == 0
