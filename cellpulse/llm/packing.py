"""Lexical retrieval packing into token sequences of fixed length.

Texts become ids of a public tokenizer, once, and are stored. A shard of
documents has a BM25 inverted index over its token ids, with document
frequencies and lengths of the whole corpus. A document that nothing holds yet
seeds a sequence; the index ranks the unused documents of the shard against
what the seed put in, and they fill the window one after another. The document
that overflows is cut, and its rest seeds the next sequence. What is left at a
shard's end is cut into sequences of a power of two, so nothing is padded.

Shards are consecutive parts of the stored table, so packing needs no shuffle.
A sequence's number is made of its partition and its place there, which a
repeated task gives again.

Defined cases: a null text is empty and has the closing id alone; rows of equal
id are packed row by row; an empty table gives an empty result; a long text is
cut over as many sequences as it fills. Only the named columns are read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellpulse.llm.common import stored

WINDOW = 2048
CLOSING = 1
#: A shard ends with this many documents or ids.
SHARD_DOCS, SHARD_IDS = 512, 1 << 21
K1, B = 1.2, 0.75
#: Pieces that a worker remembers, and those that it never forgets: few, as most are rare.
MEMO, MEMO_PIECES = 1 << 20, 1 << 15
MEMO_CHARS = 40
#: Bytes of the texts that are divided at once, which take some ten times as much meanwhile; a longer text is divided alone.
TEXT_BYTES = 1 << 20

#: Plain Latin characters, and the characters for bytes in the tokenizer's vocabulary.
PLAIN = re.compile(r"[!-~¡-ÿ]*")


def _byte_characters() -> list[str]:
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


#: What a plain character is to the tokenizer; anything else is odd, and so is the word it stands in.
SPACE, LETTER, NUMBER, MARK, ODD = range(5)


def _kind(code: int) -> int:
    character = chr(code)
    if character in "\t\n\r ":
        return SPACE
    if not PLAIN.fullmatch(character):
        return ODD
    return LETTER if character.isalpha() else NUMBER if character.isnumeric() else MARK


KINDS = np.array([_kind(code) for code in range(256)], np.uint8)
#: Kinds of bytes in UTF-8, those of two-byte characters left open.
BYTE_KINDS = np.where(np.arange(256) < 128, KINDS, ODD).astype(np.uint8)
CAPITALS = np.array([chr(code).lower() != chr(code) for code in range(256)])
LOWER = (np.arange(256) + 32 * (CAPITALS & (np.arange(256) < 128))).astype(np.uint8)


def divided(texts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts in UTF-8 that end with two line ends: bytes of all pieces, where each begins in them and in the texts.

    It divides as the tokenizer does: ``'s|'t|'re|'ve|'m|'ll|'d``, runs of
    letters, single numbers, runs of marks, in lower case. A word with an odd
    character or ``<|`` is one piece, as it stands.
    """
    data = np.frombuffer(texts, np.uint8)
    kind, low = BYTE_KINDS[data], LOWER[data]
    first = np.flatnonzero((data == 0xC2) | (data == 0xC3))  # of a two-byte character up to U+00FF
    code = (data[first] & 3) << 6 | data[first + 1] & 63
    kind[first] = kind[first + 1] = KINDS[code]
    low[first + 1] += 32 * CAPITALS[code].astype(np.uint8)
    odd = kind == ODD
    if b"<|" in texts:
        odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    if odd.any():
        spaces = np.flatnonzero(kind == SPACE)
        words = np.flatnonzero(np.logical_or.reduceat(odd, np.append(0, spaces[:-1])))
        edge = np.zeros(len(data), np.int8)
        edge[np.where(words > 0, spaces[words - 1] + 1, 0)] = 1
        edge[spaces[words]] = -1
        inside = np.cumsum(edge, dtype=np.int8).astype(bool)
        kind[inside], low[inside] = ODD, data[inside]
    begins = kind != SPACE
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    begins[first + 1] = False
    at = np.flatnonzero((data == ord("'")) & begins & (kind == MARK))
    after, last = low[at + 1], low[at + 2]
    two = ((after == ord("r")) | (after == ord("v"))) & (last == ord("e")) | (after == ord("l")) & (last == ord("l"))
    short = two | np.isin(after, np.frombuffer(b"stmd", np.uint8))
    begins[at[short] + 1] = False
    rest = (at + 2 + two)[short]
    begins[rest[kind[rest] == LETTER]] = True
    kept = kind != SPACE
    return low[kept], np.flatnonzero(begins[kept]), np.flatnonzero(begins)


class Encoder(dict):
    """Piece to its ids as bytes; the tokenizer is asked when a piece first comes.

    Spaces and line ends divide words, whatever stands in them. Words of plain
    Latin characters are divided here, all texts of a batch at once, and each different
    piece is merged by the tokenizer's model; any other word goes through the
    whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        #: The first pieces, which stay when the others are forgotten.
        self.pieces: dict[str, bytes] = {}
        self.byte_characters = _byte_characters()

    def __missing__(self, word: str) -> bytes:
        found = self.pieces.get(word)
        if found is None:
            if PLAIN.fullmatch(word) and "<|" not in word:
                marked = word if word.isascii() else "".join(map(self.byte_characters.__getitem__, word.encode()))
                found = _as_bytes([t.id for t in self.model.tokenize(marked)])
            else:
                found = _as_bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[word] = found
            if len(self.pieces) < MEMO_PIECES:
                self.pieces[word] = found
        return found

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text and the closing one, 16 bits each."""
        closing, raw = _as_bytes([CLOSING]), [(text or "").encode() for text in texts]
        if len(raw) > 1 and sum(map(len, raw)) > TEXT_BYTES:
            half = len(raw) // 2
            return self.encode_all(texts[:half]) + self.encode_all(texts[half:])
        letters, begins, at = divided(b"\n".join([*raw, b"\n"]))
        if not len(begins):
            return [closing] * len(raw)
        offsets = pa.py_buffer(np.append(begins, len(letters)).astype(np.int64))
        pieces = pa.Array.from_buffers(pa.large_string(), len(begins), [None, offsets, pa.py_buffer(letters)])
        pieces = pieces.dictionary_encode()
        different = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = pa.array(list(map(self.__getitem__, different)), pa.large_binary())
        _, offsets, ids = known.take(pieces.indices).buffers()
        text_ends = np.cumsum([len(x) + 1 for x in raw])
        ends = np.frombuffer(offsets, np.int64)[np.searchsorted(at, text_ends)].tolist()
        ids = memoryview(ids)
        return [bytes(ids[a:b]) + closing for a, b in zip([0, *ends], ends, strict=False)]

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text and the closing one, 16 bits each."""
        return self.encode_all([text])[0]


def _as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}H", *ids)


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One encoder per worker, kept between its tasks."""
    return Encoder(path)


def tokenized(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` (as text) and ``ids`` of every document, and a row of ``df`` per task: document counts by id."""
    if Tokenizer.from_file(vocabulary).get_vocab_size() > 1 << 16:
        raise ValueError("ids are stored in 16 bits")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, df, last = encoder_of(vocabulary), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        for batch in batches:
            ids = encoder.encode_all(batch["text"].tolist())
            for x in ids:
                own = np.frombuffer(x, "<u2")
                at = np.arange(len(own))
                last[own] = at
                df[own[last[own] == at]] += 1  # each id once, where it stands last
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids, "df": None})
        yield pd.DataFrame({"doc_id": [None], "ids": [None], "df": [df.tobytes()]})

    rows = docs.select(F.col(key).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(encode, "doc_id string, ids binary, df binary")


def statistics(rows: DataFrame) -> tuple[np.ndarray, int, float]:
    """Document frequency of each id, documents, and their mean length, over the whole table.

    Tasks have counted their own; their counts meet by id, of which there are at most 65,536.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x in batch["df"]:
                own = np.frombuffer(x, np.int64)
                at = np.flatnonzero(own)
                yield pd.DataFrame({"id": at, "n": own[at]})

    counts = rows.where("df is not null").select("df").mapInPandas(counted, "id long, n long")
    df = np.zeros(1 << 16, np.int64)
    for row in counts.groupBy("id").agg(F.sum("n").alias("n")).collect():
        df[row["id"]] = row["n"]
    total = rows.where("ids is not null").agg(F.count("*"), F.sum(F.octet_length("ids") / 2)).first()
    return df, total[0], (total[1] or 0) / max(1, total[0])


class Shard:
    """A BM25 index over a shard's documents."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        sizes = np.array([len(d) for d in docs])
        number = np.uint32 if len(docs) <= 1 << 16 else np.int64  # the narrower one sorts several times faster
        keys = np.concatenate(docs).astype(number) * number(len(docs)) + np.repeat(np.arange(len(docs), dtype=number), sizes)
        keys, tf = np.unique(keys, return_counts=True)
        term, self.doc = np.divmod(keys.astype(np.int64), len(docs))
        norm = K1 * (1 - B + B * sizes[self.doc] / max(mean_length, 1.0))
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm)
        self.begin = np.searchsorted(term, np.arange((1 << 16) + 1))
        self.size = len(docs)

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """The score of every document for the distinct ids of a query."""
        terms = np.unique(ids)
        begin, length = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        at = np.repeat(begin - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
        return np.bincount(self.doc[at], self.weight[at], self.size)


def pack(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW) -> list[list[tuple]]:
    """Sequences of pieces ``(document, start, length)``; every id of every document lies in one piece."""
    index = Shard(docs, idf, mean_length)
    unused, next_seed = np.ones(len(docs), bool), 0
    sequences, pieces, room = [], [], window
    doc, start, seed = None, 0, None
    while True:
        if doc is None:
            if pieces and seed is not None:
                # The best unused neighbour; with nothing in common, the first unused one.
                scores = np.where(unused, seed, -1.0)
                doc = int(scores.argmax()) if unused.any() else None
            else:
                while next_seed < len(docs) and not unused[next_seed]:
                    next_seed += 1
                doc = next_seed if next_seed < len(docs) else None
            if doc is None:
                break
            unused[doc], start = False, 0
        length = min(room, len(docs[doc]) - start)
        pieces.append((doc, start, length))
        room -= length
        if room and len(pieces) == 1 and unused.any():
            seed = index.scores(docs[doc][start : start + length])
        doc, start = (doc, start + length) if start + length < len(docs[doc]) else (None, 0)
        if not room:
            sequences.append(pieces)
            pieces, room, seed = [], window, None
    return sequences + _powers(pieces)


def _powers(pieces: list[tuple]) -> list[list[tuple]]:
    """Pieces that do not fill a window, cut into sequences of falling powers of two."""
    left = sum(length for _, _, length in pieces)
    sequences, queue = [], list(pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        own = []
        while room:
            doc, start, length = queue.pop(0)
            take = min(room, length)
            own.append((doc, start, take))
            room -= take
            if take < length:
                queue.insert(0, (doc, start + take, length - take))
        sequences.append(own)
    return sequences


PACKED = (
    "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def packed(rows: DataFrame, with_ids: bool = True, window: int = WINDOW) -> DataFrame:
    """The pieces of all sequences of a tokenized table, with their ids if asked for."""
    df, n, mean_length = statistics(rows)
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    spark = rows.sparkSession
    known = spark.sparkContext.broadcast(idf.astype(np.float64))  # one number per id of the vocabulary

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sequence, keys, docs, size = TaskContext.get().partitionId() << 32, [], [], 0

        def flush() -> pd.DataFrame:
            nonlocal sequence
            out = []
            for pieces in pack(docs, known.value, mean_length, window):
                offset = 0
                for doc, start, length in pieces:
                    ids = docs[doc][start : start + length]
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    own = ids.tobytes() if with_ids else None
                    out.append((keys[doc], start, length, crc, len(docs[doc]), sequence, offset, own))
                    offset += length
                sequence += 1
            return pd.DataFrame(out, columns=[c.split()[0] for c in PACKED.split(", ")])

        for batch in batches:
            for key, ids in zip(batch["doc_id"], batch["ids"], strict=True):
                keys.append(key)
                docs.append(np.frombuffer(ids, "<u2"))
                size += len(docs[-1])
                if len(docs) >= SHARD_DOCS or size >= SHARD_IDS:
                    yield flush()
                    keys, docs, size = [], [], 0
        if docs:
            yield flush()

    return rows.where("ids is not null").select("doc_id", "ids").mapInPandas(fill, PACKED)


def pack_documents(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents, in sequences of ``WINDOW`` ids or a power of two."""
    kind = docs.schema[key].dataType.simpleString()
    rows = packed(stored(tokenized(docs, vocabulary, key, text), "tokens"), with_ids)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast(kind))
    return rows if with_ids else rows.drop("ids")
