"""Near duplicates by a multi-index Hamming join of MinHash signatures.

A document's set holds the distinct runs of four words, lower-cased in ASCII. Sets
get signatures of ``PLACES`` symbols, each the low sixteen bits of a MinHash. Two
signatures are near if at most ``DISTANCE`` symbols differ, four standard deviations more than at
the threshold. A signature is cut into ``CHUNKS`` chunks; by the pigeonhole
principle two near ones differ in at most one symbol of some chunk. So each chunk is
indexed once for every symbol that may be in error, without it, and all near pairs meet in a bucket.

Nobody writes out the pairs of a bucket. Every set is first compared with the
nearest of its buckets' first members, exactly, which joins most of a group of
near copies. Sets whose signature is near the same first member are one chain. Buckets that hold a
single chain are done, the others compare signatures across chains only, in blocks if
they are large, and join the chains. Chains of several components are then compared exactly, whole set with whole
set, block by block and across components only. So each near pair is either joined
by others or compared.

Texts of equal words are one set. Defined cases: a null text, or one without
words, has no shingle and is linked to nothing; a text of one to three words is one shingle;
repeated rows and equal ids with equal words are copies; a null id stands in a component whose
number is the smallest id in it, null if there is none, which then equals its own; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.llm.collocations import Words, _bitmap, _constants, _mixed, _passes, _probes
from cellpulse.llm.common import stored
from cellpulse.llm.ngram_join import _grouped, components
from cellpulse.session import discard

WIDTH = 4
MIN_PERCENT = 80
PLACES = 64
#: Symbols that may differ: the mean at the threshold and four standard deviations.
DISTANCE = int(0.2 * PLACES + 4 * (0.8 * 0.2 * PLACES) ** 0.5)
#: So many chunks that one of them has at most one symbol in error.
CHUNKS = DISTANCE // 2 + 1
#: Sets of one block of a large bucket or chain, and shingles of such a block.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Sets compared with one first member by the same task.
STAR = 256
CHUNK_BYTES = 2 << 20

_U = np.uint64
_PLAIN = bytes(range(256)).translate(
    bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
)
_SCALE, _SHIFT = _constants(21, PLACES) | _U(1), _constants(22, PLACES)
_STEP = _constants(23, 1)[0] | _U(1)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of prepared texts, with repeats, and how many each text has."""
    words = Words(b"\n".join(texts))
    hashes, counts = words.hashes[0], np.bincount(words.pieces, minlength=len(texts))
    total = hashes.copy()
    for k in range(1, WIDTH):
        nxt = np.zeros(len(hashes), _U)
        nxt[: len(hashes) - k] = hashes[k:]
        inside = np.zeros(len(hashes), bool)
        inside[: len(hashes) - k] = words.pieces[k:] == words.pieces[: len(hashes) - k]
        # A shorter text ends early, so its only shingle is the hash of as many words as it has.
        total = np.where(inside, _mixed(total * _STEP + nxt), total)
    ends = np.cumsum(counts)
    found = np.where(counts > 0, np.maximum(counts - WIDTH + 1, 1), 0)
    at = np.arange(len(hashes)) - np.repeat(ends - counts, counts)
    return total[at < np.repeat(found, counts)], found


def _parts(texts: list[bytes]) -> Iterator[slice]:
    """Runs of texts whose bytes fit together in memory."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK_BYTES:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


def set_sizes_and_signatures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and signature of each text; every text has a word."""
    hashes, counts = shingles(texts)
    starts = np.cumsum(counts) - counts
    sizes = np.fromiter((len(np.unique(x)) for x in np.split(hashes, starts[1:])), np.int64, len(texts))
    found = np.empty((len(texts), PLACES), np.uint16)
    for k in range(PLACES):
        found[:, k] = np.minimum.reduceat((hashes * _SCALE[k] + _SHIFT[k]) >> _U(32), starts).astype(np.uint16)
    return sizes, found


def _prepared(text) -> bytes:
    """Words with single spaces between them."""
    return b" ".join(x for x in bytes(text).translate(_PLAIN).split(b" ") if x)


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [_prepared(t) for t in batch["text"]]
        for part in _parts(texts):
            own = texts[part]
            worded = [i for i, t in enumerate(own) if t]
            sizes, signatures = np.zeros(len(own), np.int64), [None] * len(own)
            if worded:
                sizes[worded], found = set_sizes_and_signatures([own[i] for i in worded])
                for i, row in zip(worded, found, strict=True):
                    signatures[i] = row.tobytes()
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].iloc[part],
                    "copy_key": [hashlib.md5(t).digest() if t else None for t in own],
                    "n_shingles": sizes,
                    "signature": signatures,
                }
            )


# ---------------------------------------------------------------- buckets

_BOUNDS = np.linspace(0, PLACES, CHUNKS + 1).astype(int)


def bucket_keys(signatures: np.ndarray) -> np.ndarray:
    """For every chunk and every symbol of it that may be in error, a key of the other symbols."""
    factors = _constants(24, PLACES) | _U(1)
    terms = _mixed(signatures.astype(_U) + _constants(25, PLACES)[None, :]) * factors[None, :]
    keys = []
    for chunk, (begin, end) in enumerate(zip(_BOUNDS[:-1], _BOUNDS[1:], strict=True)):
        total = terms[:, begin:end].sum(axis=1)
        keys += [_mixed(total - terms[:, i] + _U((chunk << 8) + i)) for i in range(begin, end)]
    return np.stack(keys, axis=1)


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            keys = bucket_keys(np.frombuffer(b"".join(batch["signature"]), np.uint16).reshape(-1, PLACES))
            yield pd.DataFrame({"sid": batch["sid"], "nodes": list(keys.view(np.int64))})


def buckets(sets: DataFrame) -> DataFrame:
    """``node``, ``sid`` and ``first``, the smallest in the bucket, of all buckets that hold several sets."""
    rows = sets.select("sid", "signature").mapInPandas(_index, "sid long, nodes array<long>")
    rows = rows.select(F.explode("nodes").alias("node"), "sid")
    several = rows.groupBy("node").agg(F.min("sid").alias("first"), F.max("sid").alias("last")).where("first < last")
    return rows.join(several.select("node", "first"), "node")


def _distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            a, b = (np.frombuffer(b"".join(batch[c]), np.uint16).reshape(-1, PLACES) for c in ("of_a", "of_b"))
            apart = (a != b).sum(axis=1)
            near = apart <= DISTANCE
            yield pd.DataFrame({"a": batch["a"][near], "b": batch["b"][near], "apart": apart[near].astype(np.int32)})


def nearest_firsts(members: DataFrame, sets: DataFrame) -> DataFrame:
    """For each set the nearest of the first members of its buckets, if one is near: ``a``, ``b``."""
    pairs = members.where("sid > first").select(F.col("sid").alias("a"), F.col("first").alias("b")).distinct()
    of = lambda side: sets.select(F.col("sid").alias(side), F.col("signature").alias(f"of_{side}"))
    judged = pairs.join(of("b"), "b").join(of("a"), "a").mapInPandas(_distances, "a long, b long, apart int")
    # One number holds both, so that the smallest is found without sorting.
    packed = F.shiftleft(F.col("apart").cast("long"), 57) + F.col("b")
    return judged.groupBy("a").agg(F.min(packed).alias("best")).select("a", F.col("best").bitwiseAND((1 << 57) - 1).alias("b"))


# ---------------------------------------------------------------- exact comparison


def _found_texts(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``sid`` and prepared ``text`` of wanted sets (``sid``, ``copy_key``, ``rep``).

    A bitmap of the wanted ids, of a fixed size, spares the other texts the
    shuffle; a text that passes by chance falls out in the join.
    """
    spark = docs.sparkSession
    places = wanted.where("rep is not null").select(F.xxhash64("rep").alias("id"))
    places = places.mapInPandas(_places, "place long")
    kept = spark.sparkContext.broadcast(_bitmap(places))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap = np.frombuffer(kept.value, np.uint8)
        for batch in batches:
            passes = _passes(bitmap, batch["id"].to_numpy().view(_U)) | batch["none"].to_numpy()
            texts = [_prepared(t) for t in batch["text"][passes]]
            yield pd.DataFrame({"copy_key": [hashlib.md5(t).digest() for t in texts], "text": texts})

    rows = docs.select(
        F.xxhash64(F.col(f"`{key}`")).alias("id"),
        F.col(f"`{key}`").isNull().alias("none"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    ).where("text is not null")
    found = rows.mapInPandas(pick, "copy_key binary, text binary")
    return found.join(wanted.select("sid", "copy_key"), "copy_key").select("sid", "text").dropDuplicates(["sid"])


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"place": _probes(batch["id"].to_numpy().view(_U)).ravel()})


def _sets_of(texts: list[bytes]) -> list[np.ndarray]:
    found = []
    for part in _parts(texts):
        hashes, counts = shingles(texts[part])
        found += [np.unique(x) for x in np.split(hashes, np.cumsum(counts)[:-1])]
    return found


def _linked(both: int, a: int, b: int) -> bool:
    return 100 * both >= MIN_PERCENT * (a + b - both)


def _compare_stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of sets to their first member, whose row comes ahead of theirs."""
    now, first = None, None
    for batch in batches:
        found = []
        for b, part, sid, text in batch[["b", "part", "sid", "text"]].itertuples(index=False):
            own = _sets_of([bytes(text)])[0]
            if now != (b, part):
                now, first = (b, part), own
            else:
                both = len(np.intersect1d(first, own, assume_unique=True))
                if _linked(both, len(first), len(own)):
                    found.append((sid, b))
        yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def exact_stars(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` that are linked. A ``b`` of many pairs is read by several tasks."""
    sizes = pairs.groupBy("b").agg(F.count("*").alias("n"))
    dealt = pairs.join(sizes, "b").withColumn("part", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / STAR)).cast("int"))
    own = dealt.select("b", "part", F.lit(1).alias("turn"), F.col("a").alias("sid"))
    rows = own.unionByName(dealt.select("b", "part", F.lit(0).alias("turn"), F.col("b").alias("sid")).distinct())
    rows = rows.join(texts, "sid").repartition("b", "part").sortWithinPartitions("b", "part", "turn")
    return rows.mapInPandas(_compare_stars, "a long, b long")


def _in_blocks(rows: DataFrame, group: str, weight: Column, most: tuple[int, int]) -> DataFrame:
    """Rows (``group``, ``sid``, ``comp``) once for every pair of blocks to compare, named by ``pair``.

    The largest component of a group has blocks of its own, which are not
    compared with each other, as its members are joined already.
    """
    comps = rows.groupBy(group, "comp").agg(F.count("*").alias("n"), F.sum(weight).alias("w"))
    main = comps.groupBy(group).agg(F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("all_n"), F.sum("w").alias("all_w"))
    of_main = main.select(group, F.col("m.comp").alias("comp"), "all_n", "all_w")
    known = of_main.join(comps, [group, "comp"]).select(group, F.col("comp").alias("main"), "n", "w", "all_n", "all_w")
    blocks = lambda n, w: F.ceil(F.greatest(n / most[0], w / most[1], F.lit(1))).cast("int")
    known = known.select(
        group, "main", blocks(F.col("n"), F.col("w")).alias("mains"), blocks(F.col("all_n") - F.col("n"), F.col("all_w") - F.col("w")).alias("others")
    )
    rows = rows.join(known, group)
    is_main = F.col("comp") == F.col("main")
    draw = F.xxhash64("sid")
    own = F.when(is_main, F.col("others") + F.pmod(draw, F.col("mains"))).otherwise(F.pmod(draw, F.col("others"))).cast("int")
    last = F.when(is_main, F.col("others") - 1).otherwise(F.col("others") + F.col("mains") - 1)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    pair = F.struct(F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return rows.withColumn("pair", pair).select("*", "pair.low", "pair.high").drop("pair", "main", "mains", "others", "other")


def _chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between chains (``comp``) with a pair of near signatures.

    A pair counts in the first bucket that it shares, and in one pair of blocks. Chains that
    a link has joined are one from then on, so a group gives fewer links than it holds chains.
    """
    found: list[tuple[int, int]] = []
    for group in _grouped(batches, ["node", "low", "high"]):
        rows = np.frombuffer(b"".join(group["signature"]), np.uint16).reshape(-1, PLACES)
        node, sid, own, keys = group["node"][0], group["sid"], group["own"], None
        within, label = group["low"][0] == group["high"][0], np.unique(group["comp"], return_inverse=True)[1]
        for i in range(len(sid) - 1):
            other = label[i + 1 :] != label[i]
            if not within:
                other &= own[i + 1 :] != own[i]
            at = np.flatnonzero(other) + i + 1
            at = at[(rows[at] != rows[i]).sum(axis=1) <= DISTANCE]
            if len(at):
                keys = bucket_keys(rows).view(np.int64) if keys is None else keys
                at = at[keys[i, (keys[at] == keys[i]).argmax(axis=1)] == node]
                met, first = np.unique(label[at], return_index=True)
                found += [(sid[j], sid[i]) for j in at[first]]
                label[np.isin(label, met)] = label[i]
        if len(found) > 10_000:
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
            found = []
    yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _compare_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Exact links between sets of different components, as many as hold each group together."""
    for group in _grouped(batches, ["root", "low", "high"]):
        sets, sid, comp, own = _sets_of([bytes(t) for t in group["text"]]), group["sid"], group["comp"], group["own"]
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        shared, bits = values[counts > 1], []
        for s in sets:
            flags = np.zeros(len(shared), np.uint8)
            flags[np.searchsorted(shared, s[np.isin(s, shared, assume_unique=True)])] = 1
            bits.append(int.from_bytes(np.packbits(flags).tobytes(), "big"))
        names = {c: i for i, c in enumerate(dict.fromkeys(comp.tolist()))}
        parent, mine = list(range(len(names))), [names[c] for c in comp.tolist()]

        def root(x: int, parent: list[int] = parent) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        within, found = group["low"][0] == group["high"][0], []
        order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
        for k, i in enumerate(order):
            most = 100 * len(sets[i]) / MIN_PERCENT
            for j in order[k + 1 :]:
                if len(sets[j]) > most:
                    break
                if mine[i] == mine[j] or not within and own[i] == own[j] or root(mine[i]) == root(mine[j]):
                    continue
                if _linked((bits[i] & bits[j]).bit_count(), len(sets[i]), len(sets[j])):
                    parent[root(mine[i])] = root(mine[j])
                    found.append((sid[i], sid[j]))
        yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _with_components(rows: DataFrame, joined: DataFrame) -> DataFrame:
    found = joined.select(F.col("member").alias("sid"), F.col("root").alias("of"))
    return rows.join(found, "sid", "left").withColumn("comp", F.coalesce("of", "sid")).drop("of")


def _of_several(rows: DataFrame, group: str) -> DataFrame:
    """The groups that hold several components."""
    return rows.groupBy(group).agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select(group)


def linked_sets(docs: DataFrame, sets: DataFrame, key: str, text: str) -> DataFrame:
    """``member`` and ``root`` of all sets that links lead from to a smaller one; ``sets`` has ``sid``, ``copy_key``, ``rep``."""
    members = stored(buckets(sets), "buckets")
    stars = stored(nearest_firsts(members, sets), "stars")
    either = stars.select(F.col("a").alias("sid")).unionByName(stars.select(F.col("b").alias("sid"))).distinct()
    texts = _found_texts(docs, sets.join(either, "sid", "left_semi"), key, text)
    links = stored(exact_stars(stars, texts), "links")
    joined, alike = components(links), components(stars)
    discard(stars)

    # Who is near the same first member is in one chain already; only different chains have to meet.
    mixed = _with_components(members.select("node", "sid"), alike)
    mixed = stored(mixed.join(_of_several(mixed, "node"), "node"), "mixed")
    discard(members)
    rows = _in_blocks(mixed, "node", F.lit(1), (BLOCK, BLOCK)).join(sets.select("sid", "signature"), "sid")
    rows = rows.repartition("node", "low", "high").sortWithinPartitions("node", "low", "high")
    near = stored(rows.mapInPandas(_chain, "a long, b long"), "near")
    discard(mixed)
    chains = components(near.unionByName(alike.select(F.col("member").alias("a"), F.col("root").alias("b"))))
    discard(near, alike)

    everyone = chains.unionByName(chains.select(F.col("root").alias("member"), "root").distinct())
    everyone = _with_components(everyone.select(F.col("member").alias("sid"), "root"), joined)
    everyone = everyone.join(_of_several(everyone, "root"), "root")
    everyone = stored(everyone.join(sets.select("sid", "n_shingles", "copy_key", "rep"), "sid"), "chains")
    texts = _found_texts(docs, everyone, key, text)
    rows = _in_blocks(everyone.select("root", "sid", "comp", "n_shingles"), "root", F.col("n_shingles"), (BLOCK, BLOCK_SHINGLES))
    rows = rows.join(texts, "sid").repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    more = stored(rows.mapInPandas(_compare_blocks, "a long, b long"), "links")
    discard(everyone)
    found = components(links.unionByName(more))
    discard(links, more, joined, chains)
    return found


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest id that links lead to) and ``kept`` of every document."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))
    signed = rows.mapInPandas(_sign, f"doc_id {kind}, copy_key binary, n_shingles long, signature binary")
    signed = stored(signed, "signed")
    sets = signed.where("copy_key is not null").groupBy("copy_key").agg(
        F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("signature").alias("signature")
    )
    sets = stored(sets.withColumn("sid", F.monotonically_increasing_id()), "sets")
    roots = linked_sets(docs, sets, key, text)
    named = sets.select("sid", "copy_key", "rep").join(roots, F.col("sid") == F.col("member"), "left")
    named = named.select("copy_key", "rep", F.coalesce("root", "sid").alias("root"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = stored(named.join(smallest, "root").select(F.col("copy_key").alias("of"), "component_id"), "named")
    discard(sets, roots)
    # The keys of copies may be hot; only a join splits their rows.
    found = signed.join(named, F.col("copy_key") == F.col("of"), "left")
    component = F.when(F.col("copy_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = found.select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
