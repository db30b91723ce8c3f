"""Token counts under a unigram vocabulary, without making the tokens.

A text is cut before every space, which becomes the mark of the vocabulary;
the first word gets a mark too. An Aho-Corasick automaton lists all vocabulary
pieces inside a word, and dynamic programming over their ends carries the best
score and its number of pieces. The rules are those of public unigram
tokenizers with byte fallback:

* a character that no piece of its own covers may be unknown, at the lowest
  score of the vocabulary less 10, and counts as many tokens as it has bytes;
* of equal scores the piece that begins first wins, and an unknown character
  loses to a piece.

Scores are added in double precision from the start of a word. Words repeat,
so a worker keeps the counts of those it has seen, up to ``MEMO`` of them.

Defined cases: a null or empty text has no tokens and a score of zero;
repeated rows and equal ids are counted row by row; an empty table gives an
empty result; a long text is counted word by word, a long word with state that
grows with its length. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MEMO = 1 << 20
#: Longer words are not worth keeping.
MEMO_CHARS = 40


class Counter(dict):
    """Word (without its mark) to tokens and score; counts a word when it is first asked for."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> tuple[int, float]:
        found = self.count(MARK + word)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[word] = found
        return found

    def count(self, word: str) -> tuple[int, float]:
        """Tokens and score of the best division of a word that has its mark."""
        n = len(word)
        if not n:
            return 0, 0.0
        best, tokens = [0.0] + [None] * n, [0] * (n + 1)
        at = 1  # ends before this one are settled

        def settle(upto: int, single: bool) -> None:
            """Ends that no piece reaches: the character there is unknown."""
            nonlocal at
            while at < upto:
                unknown(at)
                at += 1
            if not single:
                unknown(upto)
            at = upto + 1

        def unknown(end: int) -> None:
            score = best[end - 1] + self.unknown
            if best[end] is None or score > best[end]:
                best[end] = score
                tokens[end] = tokens[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))

        last, single = 0, False
        # Pieces come by their end, and of one end the longest first, which is the one that begins first.
        for end, (size, own) in self.automaton.iter(word):
            end += 1
            if end != last:
                if last:
                    settle(last, single)
                while at < end:
                    unknown(at)
                    at += 1
                last, single = end, False
            if size == 1:
                single = True
            score = best[end - size] + own
            if best[end] is None or score > best[end]:
                best[end], tokens[end] = score, tokens[end - size] + 1
        if last:
            settle(last, single)
        while at <= n:
            unknown(at)
            at += 1
        return tokens[n], best[n]


def words_of(text: str) -> list[str]:
    """The words that get a mark each, without it."""
    if not text:
        return []
    return (text[1:] if text[0] == " " else text).split(" ")


def count_text(counter: Counter, text: str | None) -> tuple[int, float]:
    total, score = 0, 0.0
    for tokens, own in map(counter.__getitem__, words_of(text or "")):
        total += tokens
        score += own
    return total, score


def sentencepiece_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, without its control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    )
    return [(model.id_to_piece(i), model.get_score(i)) for i in plain]


@lru_cache(maxsize=2)
def counter_of(load: Callable[[str], list[tuple[str, float]]], path: str) -> Counter:
    """One counter per worker, kept between its tasks."""
    return Counter(load(path))


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    load: Callable[[str], list[tuple[str, float]]] = sentencepiece_pieces,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key``, ``n_tokens`` and ``score`` of every whole text.

    A pass over the input without a shuffle. ``vocabulary`` is a path that
    every worker has.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = counter_of(load, vocabulary)
        for batch in batches:
            found = [count_text(counter, t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "key": batch["key"],
                    "n_tokens": [n for n, _ in found],
                    "score": [s for _, s in found],
                }
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    rows = rows.mapInPandas(counted, "key string, n_tokens long, score double")
    return rows.select(F.col("key").cast(kind).alias(key), "n_tokens", "score")
