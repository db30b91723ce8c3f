"""N-gram Jaccard join by chosen paths.

Documents whose sets of five-word shingles have a Jaccard similarity of at
least ``MIN_JACCARD`` are linked. Sets are embedded as MinHash signatures, and
every run splits them recursively: a node chooses few of the signature's places
by a hash of its path (each with probability 1 / (similarity x places), one at
least), and for each chosen place its sets fall apart by the token there.
Similar sets share a chosen token more than once a level, others hardly ever, so
buckets get small; a small bucket is compared pair by pair. Runs are repeated
until a pair at the threshold is found with probability ``RECALL``, even if every
bucket that holds both is split at all levels, ``START`` + ``ROUNDS`` x ``LEVELS``; ``recall``
works that out from the chosen places. Pairs that fall apart higher up, that are
more similar or that others connect are left out less often.

Buckets give candidates only: chains of pairs whose signatures agree. Within
each chain the whole shingle sets are then compared exactly, every pair once,
so links are counted without being written out. A chain that is too long for
one task is compared in blocks, each pair of blocks in a task of its own.

Texts of equal words are copies: they have one shingle set, which is joined
once. A text of one to four words is one shingle. Defined cases: a null text,
or one without words, is linked to nothing and a class of its own; repeated
rows and equal ids with equal words are copies; a null id stands in a class
whose number is the smallest id in it, null if there is none; an empty table
gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.llm.collocations import _bitmap, _passes, _probes
from cellpulse.llm.common import SPACE, SPACES, stored
from cellpulse.session import discard

WIDTH = 5
MIN_JACCARD = 0.8
PLACES = 128
#: Least share of pairs at the threshold that are found, whatever is split.
RECALL = 0.9998
#: Buckets up to this size are compared pair by pair (half a megabyte of signatures); larger ones are split on, in rounds of so many levels.
LEAF, LEVELS, ROUNDS = 2048, 2, 1
#: Levels below the root at which sets meet for the first time: three shared tokens make a bucket.
START = 2
#: Signatures that agree in fewer places are no candidates: four standard deviations below the threshold.
CANDIDATE = 0.8 - 4 * (0.8 * 0.2 / PLACES) ** 0.5
#: Sets in one block of an exact comparison.
BLOCK = 512
CHUNK_WORDS = 1 << 18
#: Words whose hashes a worker remembers.
MEMO = 1 << 17

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _constants(seed: int, n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


_FACTORS = _constants(1, WIDTH) | _U(1)
_SCALE, _SHIFT = _constants(2, PLACES) | _U(1), _constants(3, PLACES)
#: What decides which places a node chooses, and how many: one on average that a pair at the threshold agrees in.
_DRAWS, _LIMIT = _constants(77, PLACES), _U(int(2.0**64 / (MIN_JACCARD * PLACES)))


class _Words(dict):
    """Word to 64-bit hash, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_words = _Words()


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts one after another, with repeats, and where each text begins.

    Every text has at least one word.
    """
    lists = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.array([len(x) for x in lists])
    hashes = np.fromiter((h for x in lists for h in map(_words.__getitem__, x)), _U, int(sizes.sum()))
    ends = np.cumsum(sizes)
    padded = np.concatenate((hashes, np.zeros(WIDTH - 1, _U)))
    total = sum(padded[k : k + len(hashes)] * _FACTORS[k] for k in range(WIDTH))
    counts = np.maximum(sizes - WIDTH + 1, 1)
    keep = np.arange(len(hashes)) < np.repeat(ends - sizes + counts, sizes)
    for i in np.flatnonzero(sizes < WIDTH):
        own = hashes[ends[i] - sizes[i] : ends[i]]
        total[ends[i] - sizes[i]] = (own * _FACTORS[: len(own)]).sum() + _U(sizes[i])
    return _mixed(total[keep]), np.cumsum(counts) - counts


def signatures(texts: list[str]) -> np.ndarray:
    """A row of ``PLACES`` smallest hashes for each text, the low 16 bits of each."""
    hashes, starts = shingles(texts)
    found = np.empty((len(texts), PLACES), np.uint16)
    for k in range(PLACES):
        found[:, k] = np.minimum.reduceat(((hashes * _SCALE[k] + _SHIFT[k]) >> _U(32)).astype(np.uint32), starts).astype(np.uint16)
    return found


def chunks(texts: list[str]) -> Iterator[slice]:
    """Parts of a list of texts whose words fit together in memory (a word has two characters at least, with its space)."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) // 2 > CHUNK_WORDS:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text) // 2
    if begin < len(texts):
        yield slice(begin, len(texts))


def root_places(runs: int, similarity: float) -> list[tuple[int, int]]:
    """Run and place of each choice at the root; a run chooses at least one."""
    found = []
    for run in range(runs):
        draw = _constants(1000 + run, PLACES)
        chosen = np.flatnonzero(draw < _U(int(2.0**64 / (similarity * PLACES))))
        found += [(run, int(k)) for k in (chosen if len(chosen) else [int(draw.argmin())])]
    return found


@cache
def recall(runs: int, depth: int) -> float:
    """Probability that a pair at the threshold meets in a bucket ``depth`` levels below the root and is a candidate.

    Given in how many places a pair agrees, a choice of places is a branching
    process: each chosen place that it agrees in leads one level down.
    """
    chance = 1 / (MIN_JACCARD * PLACES)
    choose = [comb(PLACES, k) * chance**k * (1 - chance) ** (PLACES - k) for k in range(PLACES + 1)]
    times = Counter(k for _, k in root_places(runs, MIN_JACCARD)).values()
    found = 0.0
    for equal in range(int(np.ceil(CANDIDATE * PLACES)), PLACES + 1):
        share, apart = equal / PLACES, 0.0
        for _ in range(depth):
            apart = sum(p * (1 - share + share * apart) ** max(k, 1) for k, p in enumerate(choose))
        missed = float(np.prod([1 - share + share * apart**n for n in times]))
        found += comb(PLACES, equal) * MIN_JACCARD**equal * (1 - MIN_JACCARD) ** (PLACES - equal) * (1 - missed)
    return found


@cache
def runs_for(target: float) -> int:
    """The fewest runs that find pairs at the threshold with this probability at the full depth."""
    runs = 1
    while recall(runs, START + ROUNDS * LEVELS) < target:
        runs += 1
        if runs > 1000:
            raise ValueError(f"a recall of {target} is out of reach with {PLACES} places")
    return runs


def _node(parent: np.ndarray, place: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The path of a child as a number."""
    return _mixed(_mixed(parent + _U(0x632BE59BD9B4E019) * (place.astype(_U) + _U(1))) + token.astype(_U))


def normal(text: Column) -> Column:
    """The words of a text with single spaces between them."""
    return F.regexp_replace(F.btrim(text, F.lit(SPACES)), SPACE + "+", " ")


def signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id`` (as text), ``copy_key`` and ``signature`` of every document that has words."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch["text"])
            for part in chunks(texts):
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].iloc[part],
                        "copy_key": batch["copy_key"].iloc[part],
                        "signature": [row.tobytes() for row in signatures(texts[part])],
                    }
                )

    rows = docs.select(F.col(f"`{key}`").cast("string").alias("doc_id"), normal(F.col(f"`{text}`")).alias("text"))
    rows = rows.where(F.col("text") != "").select("doc_id", F.md5("text").alias("copy_key"), "text")
    return rows.mapInPandas(sign, "doc_id string, copy_key string, signature binary")


def first_nodes(sets: DataFrame, runs: int) -> DataFrame:
    """``node`` and ``copy_key`` of every set ``START`` levels below the root places.

    Worked out where signatures lie: a path needs its own set only, so nothing is shuffled or stored above.
    """
    places = root_places(runs, MIN_JACCARD)
    run_of = np.array([r for r, _ in places], _U)
    place_of = np.array([k for _, k in places])

    def nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), 2048):
                part = batch.iloc[begin : begin + 2048]
                tokens = _decoded(part["signature"])
                node = _node(run_of, place_of, tokens[:, place_of]).ravel()
                owner = np.repeat(np.arange(len(part)), len(places))
                for _ in range(START):
                    node, _, owner = _below(node, owner, tokens)
                yield pd.DataFrame({"node": node.view(np.int64), "copy_key": part["copy_key"].to_numpy()[owner]})

    return sets.select("copy_key", "signature").mapInPandas(nodes, "node long, copy_key long")


def holding(ids: DataFrame) -> Callable[[Column], Column]:
    """A test whether an id (text) may be among ``ids``, by a bitmap of a fixed size; it never misses one.

    It spares rows that are surely not meant the shuffle of a join.
    """
    hashes = ids.select(F.xxhash64(F.col(ids.columns[0])).alias("id"))

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"place": _probes(batch["id"].to_numpy().view(_U)).ravel()})

    kept = ids.sparkSession.sparkContext.broadcast(_bitmap(hashes.mapInPandas(places, "place long")))

    @F.pandas_udf("boolean")
    def holds(hashes: pd.Series) -> pd.Series:
        return pd.Series(_passes(np.frombuffer(kept.value, np.uint8), hashes.to_numpy().view(_U)))

    return lambda column: holds(F.xxhash64(column))


# ---------------------------------------------------------------- buckets


def _chains(rows: np.ndarray) -> np.ndarray:
    """The first member of each one's chain, links being signatures that agree in enough places."""
    label = np.arange(len(rows))
    for i in range(len(rows) - 1):
        near = np.flatnonzero((rows[i + 1 :] == rows[i]).sum(axis=1) >= CANDIDATE * PLACES) + i + 1
        if len(near):
            own = np.unique(label[np.append(near, i)])
            if len(own) > 1:
                label[np.isin(label, own)] = own[0]
    return label


def _grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Groups of rows that follow one another, put together across batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        change = np.zeros(len(batch), bool)
        for k in keys:
            values = batch[k].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        if held and any(held[0][k].iloc[0] != batch[k].iloc[0] for k in keys):
            yield _columns(held)
            held = []
        begin = 0
        columns = {c: batch[c].to_numpy() for c in batch.columns}
        for end in np.flatnonzero(change):
            if held:
                yield _columns([*held, batch.iloc[:end]])
                held = []
            else:
                yield {c: v[begin:end] for c, v in columns.items()}
            begin = int(end)
        held.append(batch.iloc[begin:])
    if held:
        yield _columns(held)


def _columns(parts: list[pd.DataFrame]) -> dict[str, np.ndarray]:
    whole = pd.concat(parts) if len(parts) > 1 else parts[0]
    return {c: whole[c].to_numpy() for c in whole.columns}


def _decoded(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, PLACES)


def _compare_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chains of agreeing signatures in small buckets, as links to their first members."""
    found: list[tuple[int, int]] = []
    for group in _grouped(batches, ["node", "pair"]):
        keys = group["copy_key"]
        if len(keys) > 1:
            roots = _chains(_decoded(group["signature"]))
            found += [(keys[i], keys[r]) for i, r in enumerate(roots) if i != r]
        if len(found) > 10_000:
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
            found = []
    yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _chosen(node: np.ndarray, draws: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Which places each node chooses; one at least, as a node without any would lose its sets."""
    drawn = _mixed(node[:, None] ^ draws[None, :])
    chosen = drawn < limit
    none = np.flatnonzero(~chosen.any(axis=1))
    chosen[none, drawn[none].argmin(axis=1)] = True
    return chosen


def _below(node: np.ndarray, owner: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The children of nodes, their parents, and whose they are; ``owner`` is the row of ``tokens`` of each node."""
    row, place = np.nonzero(_chosen(node, _DRAWS, _LIMIT))
    parent, owner = node[row], owner[row]
    return _node(parent, place, tokens[owner, place]), parent, owner


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The paths of sets below a large bucket, level by level: each node chooses its places by its own path."""
    for batch in batches:
        for begin in range(0, len(batch), 4096):
            part = batch.iloc[begin : begin + 4096]
            node, owner = part["node"].to_numpy().view(_U), np.arange(len(part))
            tokens, keys = _decoded(part["signature"]), part["copy_key"].to_numpy()
            for depth in range(1, LEVELS + 1):
                node, parent, owner = _below(node, owner, tokens)
                yield pd.DataFrame(
                    {
                        "node": node.view(np.int64),
                        "parent": parent.view(np.int64),
                        "depth": depth,
                        "copy_key": keys[owner],
                    }
                )


def _agree(a: Column, b: Column) -> Column:
    """Share of equal places of two signatures, without Python."""
    cut = lambda s, i: F.substring(s, i * 2 + 1, F.lit(2))
    places = F.sequence(F.lit(0), F.lit(PLACES - 1))
    return F.size(F.filter(places, lambda i: cut(a, i) == cut(b, i))) / F.lit(PLACES)


def candidates(sets: DataFrame, runs: int) -> DataFrame:
    """Links ``a``, ``b`` of candidate chains among distinct sets (``copy_key``, a number, and ``signature``)."""
    slim = sets.select("copy_key", "signature")
    rows = first_nodes(sets, runs)
    members = stored(rows.join(_sizes(rows), "node"), "buckets")
    buckets, links, used = members.where(F.col("n") <= LEAF).select("node", F.lit(0).alias("pair"), "copy_key"), None, [members]
    rest = members.where(F.col("n") > LEAF).select("node", "copy_key")
    for turn in range(ROUNDS + 1):
        if rest.isEmpty():
            break
        stars, rest = _around_first(rest, slim)
        links = stars if links is None else links.unionByName(stars)
        if turn == ROUNDS:  # what no split has made small is compared in blocks
            counts = rest.groupBy("node").agg(F.count("*").alias("n"))
            blocks = F.ceil(F.col("n") / LEAF).cast("int")
            blocked = _in_blocks(rest.join(counts, "node"), "node", blocks)
            buckets = buckets.unionByName(blocked.select("node", "pair", "copy_key"))
            break
        # A path needs its own set only, so a hot bucket is dealt out by sets.
        deep = rest.select("node", "copy_key", "signature").repartition("copy_key")
        deep = stored(deep.mapInPandas(_split, "node long, parent long, depth int, copy_key long"), "paths")
        # A node's own size, and whether its parent is large and so split further, are known for every path.
        sized = stored(deep.join(_sizes(deep), "node"), "buckets")
        used += [deep, sized]
        large = sized.where((F.col("n") > LEAF) & (F.col("depth") < LEVELS)).select(F.col("node").alias("parent")).distinct()
        below = sized.where("depth > 1").join(large, "parent", "left_semi")
        small = sized.where("depth = 1").unionByName(below.select(sized.columns)).where(F.col("n") <= LEAF)
        buckets = buckets.unionByName(small.select("node", F.lit(0).alias("pair"), "copy_key"))
        rest = sized.where((F.col("depth") == LEVELS) & (F.col("n") > LEAF)).select("node", "copy_key")
    compared = stored(_in_buckets(buckets.join(slim, "copy_key")), "links")
    if links is None:
        discard(*used)
        return compared
    both = stored(compared.unionByName(links), "links")
    discard(compared, *used)
    return both


def _sizes(rows: DataFrame) -> DataFrame:
    """Nodes that hold more than one set, and how many."""
    return stored(rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "sizes")


def _around_first(rows: DataFrame, slim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of all that agree with the first set of their large bucket, and the rows of buckets where some do not.

    A bucket of near copies is one chain after this, however many they are.
    """
    first = rows.groupBy("node").agg(F.min("copy_key").alias("first"))
    first = first.join(slim, F.col("first") == F.col("copy_key")).select("node", "first", F.col("signature").alias("of_first"))
    near = _agree(F.col("signature"), F.col("of_first")) >= CANDIDATE
    judged = rows.join(stored(first, "first"), "node").join(slim, "copy_key")
    judged = stored(judged.select("node", "first", "copy_key", "signature", near.alias("near")), "large")
    stars = judged.where("near and copy_key != first").select(F.col("copy_key").alias("a"), F.col("first").alias("b"))
    mixed = judged.where("not near").select("node").distinct()
    return stars, judged.join(mixed, "node", "left_semi")


def _in_blocks(rows: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Rows of each group dealt to blocks, once for every pair of blocks that theirs is in; ``pair`` names it."""
    own = F.pmod(F.xxhash64("copy_key"), blocks).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("pair", F.least("own", "other") * F.lit(1 << 16) + F.greatest("own", "other"))


def _in_buckets(rows: DataFrame) -> DataFrame:
    rows = rows.select("node", "pair", "copy_key", "signature").repartition("node", "pair")
    return rows.sortWithinPartitions("node", "pair").mapInPandas(_compare_buckets, "a long, b long")


# ---------------------------------------------------------------- chains


def components(links: DataFrame) -> DataFrame:
    """``member`` and ``root``, the smallest of its chain, for all but the roots.

    Large stars and small stars in turn: all larger neighbours of a member go to
    its smallest one, then all smaller ones. Rows of two keys are all that is
    sorted by member.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, before = stored(ordered.where("a != b").distinct(), "edges"), None
    smallest = F.min("b").over(Window.partitionBy("a"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.withColumn("m", F.least("a", smallest)).where("b > a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = large.withColumn("m", smallest)
        # The member itself goes to the smallest one, and so do its other smaller neighbours.
        small = small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("x"), "a", "m")
        pairs = small.select(F.explode(F.array_distinct(F.array("x", "a"))).alias("a"), F.col("m").alias("b"))
        edges, earlier = stored(pairs.distinct(), "edges"), edges
        discard(earlier)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return edges.select(F.col("a").alias("member"), F.col("b").alias("root"))
        before = now


# ---------------------------------------------------------------- exact comparison


def exact_links(texts: list[str], side: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """How many others each text is linked to, and the first member of its chain of links.

    With ``side`` only pairs on different sides count.
    """
    sets = []
    for part in chunks(texts):
        hashes, starts = shingles(texts[part])
        sets += [np.unique(x) for x in np.split(hashes, starts[1:])]
    sizes = [len(s) for s in sets]
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    shared = values[counts > 1]
    bits = []
    for s in sets:
        at = np.searchsorted(shared, s)
        at = at[(at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == s)] if len(shared) else at[:0]
        flags = np.zeros(len(shared), np.uint8)
        flags[at] = 1
        bits.append(int.from_bytes(np.packbits(flags).tobytes(), "big"))
    n, parent = [0] * len(sets), list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = sorted(range(len(sets)), key=lambda i: sizes[i])
    for k, i in enumerate(order):
        most = sizes[i] * 5  # a set of more than size / 0.8 cannot reach 0.8
        for j in order[k + 1 :]:
            if 4 * sizes[j] > most:
                break
            if side is not None and side[i] == side[j]:
                continue
            both = (bits[i] & bits[j]).bit_count()
            if 5 * both >= 4 * (sizes[i] + sizes[j] - both):
                n[i] += 1
                n[j] += 1
                a, b = find(i), find(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    return n, [find(i) for i in range(len(sets))]


def _compare_exactly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for group in _grouped(batches, ["root", "pair"]):
        own, other = divmod(int(group["pair"][0]), 1 << 16)
        side = None if own == other else group["own"]
        n, first = exact_links(list(group["text"]), side)
        keys = group["copy_key"]
        yield pd.DataFrame({"a": keys, "b": [keys[i] for i in first], "n_links": n})


def links_of(docs: DataFrame, reps: DataFrame, chains: DataFrame, key: str, text: str) -> DataFrame:
    """Exact links: ``a`` linked, in a chain with ``b``, to ``n_links`` others of one pair of blocks.

    Only one document of each copied text moves, found by its id.
    """
    sizes = chains.groupBy("root").agg((F.count("*") + 1).alias("n"))
    everyone = chains.unionByName(chains.select(F.col("root").alias("member"), "root").distinct())
    wanted = everyone.join(sizes, "root").join(reps, F.col("member") == F.col("sid"))
    wanted = stored(wanted.select("root", "n", "copy_key", F.coalesce("rep", "copy_key").alias("found_by")), "wanted")
    rows = docs.select(F.col(f"`{key}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = rows.select(F.coalesce("id", F.md5(normal(F.col("text")))).alias("by"), "text")
    rows = rows.where(holding(wanted.select("found_by"))(F.col("by"))).join(wanted, F.col("by") == F.col("found_by"))
    rows = rows.where(F.md5(normal(F.col("text"))) == F.col("copy_key"))
    rows = rows.select("root", "n", "copy_key", "text").dropDuplicates(["copy_key"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = _in_blocks(rows, "root", blocks).select("root", "pair", "own", "copy_key", "text")
    rows = rows.repartition("root", "pair").sortWithinPartitions("root", "pair")
    return rows.mapInPandas(_compare_exactly, "a string, b string, n_links long")


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", runs: int | None = None) -> DataFrame:
    """The class, copies and links of every document with words; ``doc_id`` as text.

    ``copy_key`` names its words and ``class_key`` its class. ``copy_id`` is the smallest id among its copies, ``class_id`` among all
    that links lead to; ``n_links`` counts the other texts it is linked to.
    """
    kind = docs.schema[key].dataType.simpleString()
    found = stored(signed(docs, key, text), "signed")
    ids = F.col("doc_id").cast(kind)
    sets = found.groupBy("copy_key").agg(
        F.min(ids).alias("rep"), F.count("*").alias("n_copies"), F.any_value("signature").alias("signature")
    )
    # Stored with a number, so that the many rows of the buckets are two numbers each.
    sets = stored(sets.withColumn("sid", F.monotonically_increasing_id()), "sets")
    members = stored(found.select("doc_id", "copy_key"), "members")
    discard(found)
    reps = sets.select("sid", "copy_key", F.col("rep").cast("string").alias("rep"))
    near = candidates(sets.select(F.col("sid").alias("copy_key"), "signature"), runs or runs_for(RECALL))
    chains = components(near)
    links = stored(links_of(docs, reps, chains, key, text), "links")
    discard(near, chains)
    linked = links.groupBy(F.col("a").alias("linked_key")).agg(F.sum("n_links").alias("n_links")).where("n_links > 0")
    roots = components(links.select("a", "b"))
    numbers = sets.select("copy_key", F.col("rep").alias("copy_id"), "n_copies")
    known = numbers.join(linked, F.col("copy_key") == F.col("linked_key"), "left").join(
        roots, F.col("copy_key") == F.col("member"), "left"
    )
    known = known.select(
        "copy_key",
        "copy_id",
        "n_copies",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("root", "copy_key").alias("root"),
    ).where("n_copies > 1 or n_links > 0")
    known = stored(known, "known")
    discard(sets, links)
    smallest = known.groupBy(F.col("root").alias("of_root")).agg(F.min("copy_id").alias("class_id"))
    known = known.join(smallest, F.col("root") == F.col("of_root")).select(
        F.col("copy_key").alias("known_key"), "root", "copy_id", "n_copies", "n_links", "class_id"
    )
    rows = members.select("doc_id", "copy_key").join(known, F.col("copy_key") == F.col("known_key"), "left")
    alone = F.col("known_key").isNull()
    return rows.select(
        "doc_id",
        "copy_key",
        F.coalesce("root", "copy_key").alias("class_key"),
        F.when(alone, ids).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(alone, ids).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: its class, its copies, and how many other texts it is linked to."""
    found = jaccard_join(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "class_id", "copy_id", "n_copies", "n_links")
    wordless = docs.where(F.coalesce(normal(F.col("text")), F.lit("")) == "")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return found.unionByName(
        wordless.select(
            "doc_id",
            F.col("doc_id").alias("class_id"),
            F.col("doc_id").alias("copy_id"),
            one.alias("n_copies"),
            none.alias("n_links"),
        )
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that another one of their class stands for, in their own columns.

    The smallest id of a class stays, a null one last; where several rows share
    it, the first copy key, and one row of it. Documents without words stay.
    """
    found = stored(jaccard_join(docs, key, text), "classes")
    kind = docs.schema[key].dataType.simpleString()
    several = found.where("n_copies > 1 or n_links > 0").select(
        F.coalesce("doc_id", F.lit("")).alias("id"), F.col("doc_id").cast(kind).alias("own"), "copy_key", "class_key"
    )
    order = F.struct(F.col("own").isNull().alias("last"), F.col("own"), F.col("id"), F.col("copy_key"))
    stays = several.groupBy("class_key").agg(F.min(order).alias("s")).select("s.id", "s.copy_key")
    rows_of = several.groupBy("id", "copy_key").agg(F.count("*").alias("n"))
    decided = rows_of.join(stays.withColumn("stays", F.lit(True)), ["id", "copy_key"], "left")
    decided = decided.where("stays is null or n > 1").select(
        F.col("id").alias("of_id"), F.col("copy_key").alias("of_key"), F.col("stays").isNull().alias("goes")
    )
    decided = stored(decided, "decided")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("id"),
    )
    # Most rows are surely not decided about; they stay where they lie.
    rows = rows.withColumn("met", holding(decided.select("of_id"))(F.col("id")))
    met = rows.where("met").withColumn("copy_key", F.md5(normal(F.col(f"row.`{text}`"))))
    met = met.join(decided, (F.col("id") == F.col("of_id")) & (F.col("copy_key") == F.col("of_key")), "left")
    once = met.where("goes is null").select("row.*")
    first = met.where("not goes").dropDuplicates(["id", "copy_key"]).select("row.*")
    discard(found)
    return rows.where("not met").select("row.*").unionByName(once).unionByName(first)
