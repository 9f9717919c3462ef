"""Near-duplicates by SimHash, found with vantage-point trees.

A text's fingerprint has a bit set where more than half of its shingle hashes have it.
Equal fingerprints are reduced to one before anything else. Fingerprints are then cut
into blocks; if two differ in at most ``d`` bits, one of ``b`` blocks differs in at most
``d // b`` (the pigeonhole principle), so each block gets a vantage-point tree that is
searched with that radius: on whole fingerprints a tree could prune next to nothing, as
their distances crowd around half the bits. A node of a tree splits values at the median
distance to a vantage point; the triangle inequality says which branches a value's ball
reaches. Leaves are shards: a value lies in its own and is a query in every later one
beyond a boundary that its ball crosses, so two values within the radius meet in the leaf
of the later one. There exact distances give a spanning forest of the links, so a group of
n copies yields no more than n - 1 edges. Leaves with very many fingerprints are handled
as pairs of chunks.

The trees are fitted on a bounded sample of fingerprints (``SAMPLE``), so a tree has no
more leaves than that; every fingerprint is placed. Null and blank texts have the fingerprint zero and are linked like any other.
Null ids come last when a group's representative is chosen. Repeated rows are members of
their group like others. Columns other than id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landspark.functions.components import components
from landspark.llm.common import Scratch, content_key, materialize, plainly_named, small_batches

#: Fingerprints on which the trees are fitted, at most.
SAMPLE = 100_000
#: Fingerprints that a leaf should have, and those above which it is cut into chunks.
LEAF_ROWS, CHUNK_ROWS = 400, 6_000
#: The same for the trees of near-duplicates, and the share of links at the threshold that these are to find.
NEAR_LEAF_ROWS, RECALL = 1_000, 0.99
#: Shingles of the sets that also meet by shingles, as few shingles make bits differ more than many do.
FEW = 25
#: Bytes of shingle sets above which a leaf is cut into chunks.
CHUNK_BYTES = 16_000_000

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``words`` words (all words if fewer), A-Z in lower case."""
    split = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()  # white space of ASCII
    if not split:
        return np.zeros(0, "<u8")
    n = max(1, len(split) - words + 1)
    line = b" ".join(split)
    ends = np.cumsum(np.fromiter(map(len, split), "i8", len(split)) + 1) - 1
    first, last = [0, *(ends[: n - 1] + 1).tolist()], (ends[words - 1 :] if len(split) >= words else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter([digest(line[a:b], seed) for a, b in zip(first, last, strict=True)], "<u8", n)


#: What further lanes add to a hash before it is mixed anew.
_LANES = np.array([k * 0x9E3779B97F4A7C15 % 2**64 for k in range(16)], "<u8")


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> np.ndarray:
    """The majority bits, 64 for each lane; further lanes mix the same hashes anew."""
    out, step = np.zeros((lanes, 64), "i8"), 255 * 64
    for at in range(0, len(hashes), step):
        mixed = np.empty((lanes, min(step, len(hashes) - at)), "<u8")
        mixed[0] = hashes[at : at + step]
        if lanes > 1:
            rest = (mixed[0] + _LANES[1:lanes, None]) * np.uint64(0xBF58476D1CE4E5B9)
            rest = (rest ^ (rest >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            mixed[1:] = rest ^ (rest >> np.uint64(32))
        bits = np.unpackbits(mixed.view("u1").reshape(lanes, -1, 8), axis=2, bitorder="little")
        full = bits.shape[1] // 255 * 255  # sums of 255 bits fit in a byte
        if full:
            out += bits[:, :full].reshape(lanes, -1, 255, 64).sum(2, dtype="u1").sum(1, dtype="i8")
        out += bits[:, full:].sum(1, dtype="u1")
    return np.packbits(out * 2 > len(hashes), axis=1, bitorder="little").view("<u8")[:, 0] if len(hashes) else np.zeros(lanes, "<u8")


def set_key(hashes: np.ndarray, lanes: int) -> bytes:
    """The fingerprint of the distinct shingles, and 8 bytes that tell unequal sets of equal fingerprint apart."""
    own = np.unique(hashes)
    return fingerprint(own, lanes).tobytes() + xxhash.xxh64_digest(own.tobytes())


def prefix(hashes: np.ndarray, least: float) -> np.ndarray:
    """The least hashes of a small set, so many that any set as alike as ``least`` has one of them among its own."""
    own = np.unique(hashes)
    return own[: len(own) - math.ceil(least * len(own) - 1e-9) + 1] if 0 < len(own) <= FEW else own[:0]


def few_shingles(docs: DataFrame, words: int, least: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keys, fp``: the :func:`set_key` of 256 bits, and for sets of at most ``FEW`` shingles their :func:`prefix`; map-only."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [shingle_hashes(t.as_py(), words) for t in b.column(1)]
            keys = pa.array([prefix(h, least).view("<i8") for h in hashes], pa.list_(pa.int64()))
            yield pa.record_batch([b.column(0), keys, pa.array([set_key(h, 4) for h in hashes], pa.binary())], names=["doc_id", "keys", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, keys array<long>, fp binary")


def fingerprints(docs: DataFrame, words: int = 4, lanes: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint as ``8 * lanes`` little-endian bytes; map-only.

    Repeated shingles count as often as they come.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(shingle_hashes(t.as_py(), words), lanes).tobytes() for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(fps, pa.binary())], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp binary")


def as_rows(fps: list[bytes], bits: int) -> np.ndarray:
    """Fingerprints as rows of bytes, without what follows them in a key."""
    return np.frombuffer(b"".join(fps), "u1").reshape(len(fps), len(fps[0]) if fps else bits // 8)[:, : bits // 8]


def block_bits(total: int, blocks: int) -> list[np.ndarray]:
    """The bits of each of so many nearly equal blocks."""
    return np.array_split(np.arange(total), blocks)


def block_values(fps: np.ndarray, blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The value of each block of each fingerprint (rows of bytes)."""
    every = np.unpackbits(fps, axis=1, bitorder="little")
    return [(every[:, own].astype("u8") << np.arange(len(own), dtype="u8")).sum(1, dtype="u8") for own in blocks]


class VantageTree:
    """A vantage-point tree fitted on sampled values of a block, to leaves of at most ``leaf_share`` of them.

    A child of a node is a later node, or leaf ``k`` as ``-k - 1``.
    """

    def __init__(self, radius: int, sample: np.ndarray, leaf_share: float, seed: int):
        rng = np.random.default_rng(seed)
        self.radius, self.n_leaves = radius, 0
        vantage, split, children = [], [], []
        open_nodes = [(sample.astype("u8"), -1, 0)]
        while open_nodes:
            own, parent, side = open_nodes.pop()
            d = most = None
            if len(own) > max(1.0, leaf_share * len(sample)):
                d = np.bitwise_count(own ^ (at := rng.choice(own)))
                most = int(d.max())
            if not most:  # small enough, or all values are equal
                node, self.n_leaves = -self.n_leaves - 1, self.n_leaves + 1
            else:
                node = len(vantage)
                vantage.append(at), split.append(min(int(np.median(d)), most - 1)), children.append([0, 0])
                open_nodes += [(own[d > split[-1]], node, 1), (own[d <= split[-1]], node, 0)]
            if parent < 0:
                self.root = node
            else:
                children[parent][side] = node
        self.vantage, self.split, self.children = np.array(vantage, "u8"), np.array(split, "i8"), np.array(children, "i8").reshape(-1, 2)

    def reached(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, leaf, whether it is the row's own`` of every leaf that a value's ball reaches."""
        row, node, own = np.arange(len(values)), np.full(len(values), self.root), np.ones(len(values), bool)
        done = []
        while True:
            leaf = node < 0
            done.append((row[leaf], -node[leaf] - 1, own[leaf]))
            row, node, own = row[~leaf], node[~leaf], own[~leaf]
            if not len(row):
                return tuple(np.concatenate(x) for x in zip(*done, strict=True))
            d = np.bitwise_count(values[row] ^ self.vantage[node]).astype("i8")
            near = d <= self.split[node]
            # triangle inequality: what is within the radius lies within it of this distance
            left, right = d - self.radius <= self.split[node], d + self.radius > self.split[node]
            row, node, own = np.concatenate([row[left], row[right]]), np.concatenate([self.children[node[left], 0], self.children[node[right], 1]]), np.concatenate([(own & near)[left], (own & ~near)[right]])

    def placed(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As :meth:`reached`, with no leaf before a row's own: one of two near values is sent to the other."""
        row, leaf, own = self.reached(values)
        home = np.empty(len(values), "i8")
        home[row[own]] = leaf[own]
        keep = leaf >= home[row]
        return row[keep], leaf[keep], own[keep]


def forest(fps: np.ndarray, most: int, own: int | None = None) -> list[tuple[int, int]]:
    """A spanning forest of least distances over rows (of 64-bit words) at most that far apart.

    With ``own``, the first so many rows are held against all, others not against each other.
    """
    n, words = fps.shape
    own = n if own is None else own
    if n < 2 or not own:
        return []
    left, right, dist, count = [], [], [], 0
    step = max(1, 2_000_000 // n)
    for at in range(0, own, step):
        some = fps[at : min(at + step, own)]
        d = np.bitwise_count(some[:, None, 0] ^ fps[None, :, 0]).astype("u2")
        for w in range(1, words):
            d += np.bitwise_count(some[:, None, w] ^ fps[None, :, w])
        i, j = np.nonzero(d <= most)
        keep = j > i + at
        left.append(i[keep] + at), right.append(j[keep]), dist.append(d[i[keep], j[keep]])
        count += len(left[-1])
        if count > 20 * n:  # one tight group: grow trees instead of listing its pairs
            return _grown(fps, most)
    i, j, d = np.concatenate(left), np.concatenate(right), np.concatenate(dist)
    order = np.argsort(d, kind="stable")
    parent, out = list(range(n)), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            out.append((a, b))
    return out


def _grown(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """As :func:`forest`, by Prim's method: linear memory and one vector step per row."""
    n = len(fps)
    best, source, free = np.full(n, 60_000, "i4"), np.full(n, -1), np.ones(n, bool)
    out = []
    for _ in range(n):
        k = int(np.argmin(np.where(free, best, 70_000)))
        if source[k] >= 0 and best[k] <= most:
            out.append((int(source[k]), k))
        free[k] = False
        d = np.bitwise_count(fps ^ fps[k]).sum(1, dtype="i4")
        nearer = free & (d < best)
        best[nearer], source[nearer] = d[nearer], k
    return out


class Shards:
    """Vantage-point trees over blocks of distinct fingerprints, and the placing of these in their leaves."""

    def __init__(self, distinct: DataFrame, bits: int, radius: int, blocks: Callable[[int], list[np.ndarray]], leaf_rows: int = LEAF_ROWS):
        """``distinct`` has one column ``fp``, of which the first ``bits`` count; ``blocks`` gives the bits of each block for a number of rows."""
        self.distinct, self.bits, self.radius = distinct, bits, radius
        n = distinct.count()
        some = distinct.orderBy(F.xxhash64("fp")).limit(SAMPLE) if n > SAMPLE else distinct
        sample = as_rows(some.toArrow().column("fp").to_pylist(), bits)
        self.blocks = blocks(n)
        self.trees = [VantageTree(radius, v, leaf_rows / max(n, 1), seed=t) for t, v in enumerate(block_values(sample, self.blocks))]
        self.shared = distinct.sparkSession.sparkContext.broadcast((self.blocks, self.trees))  # a few numbers for each sampled fingerprint

    def place(self) -> DataFrame:
        """``tree, leaf, lo, hi, own, fp``: every leaf that a fingerprint is sent to; full leaves are cut into pairs of chunks.

        Leaves are counted first, then the fingerprints are placed again, so that none is written twice.
        """
        bits, shared = self.bits, self.shared

        def leaves(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
            blocks, trees = shared.value
            for t, (tree, v) in enumerate(zip(trees, block_values(as_rows(batch.column(0).to_pylist(), bits), blocks), strict=True)):
                yield t, *tree.placed(v)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for t, _, leaf, _ in leaves(b):
                    which, n = np.unique(leaf, return_counts=True)
                    yield pa.record_batch([pa.array(np.full(len(which), t), pa.int32()), pa.array(which, pa.int32()), pa.array(n, pa.int64())], names=["tree", "leaf", "n"])

        full = self.distinct.mapInArrow(count, "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n")).filter(F.col("n") > CHUNK_ROWS)
        chunks = {(r["tree"], r["leaf"]): -(-r["n"] // CHUNK_ROWS) for r in full.collect()}  # no more than the trees have leaves
        cut = self.distinct.sparkSession.sparkContext.broadcast(chunks)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                digest = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in b.column(0).to_pylist()), "u8", b.num_rows)
                for t, row, leaf, own in leaves(b):
                    k = np.ones(len(leaf), "i8")
                    for one in {x for tree, x in cut.value if tree == t}.intersection(leaf.tolist()):
                        k[leaf == one] = cut.value[t, one]
                    again = np.repeat(np.arange(len(row)), k)
                    other = np.arange(len(again)) - np.repeat(np.cumsum(k) - k, k)
                    chunk = (digest[row] % k.astype("u8")).astype("i8")[again]
                    columns = [pa.array(np.full(len(again), t), pa.int32()), pa.array(leaf[again], pa.int32()), pa.array(np.minimum(chunk, other), pa.int32()), pa.array(np.maximum(chunk, other), pa.int32()), pa.array(own[again]), b.column(0).take(pa.array(row[again]))]
                    yield pa.record_batch(columns, names=["tree", "leaf", "lo", "hi", "own", "fp"])

        return self.distinct.mapInArrow(deal, "tree int, leaf int, lo int, hi int, own boolean, fp binary")


def own_first(rows: pa.Table) -> tuple[pa.Table, int]:
    """A leaf's rows, those that lie in it before those that are sent there, and how many lie in it."""
    own = rows.column("own").combine_chunks()
    order = np.argsort(~own.to_numpy(zero_copy_only=False), kind="stable")
    return rows.take(pa.array(order)), own.true_count


def links(distinct: DataFrame, bits: int, most: int, blocks: int) -> DataFrame:
    """``a, b``: forest edges over the links between distinct fingerprints.

    ``distinct`` has one column ``fp``, of which the first ``bits`` count. Trees are
    searched with the radius ``most // blocks``, so no link of at most ``most`` bits is
    lost. Only the sample, and one count for each full leaf, reach the driver.
    """
    shards = Shards(distinct, bits, most // blocks, lambda n: block_bits(bits, blocks))

    def within(rows: pa.Table) -> pa.Table:
        rows, own = own_first(rows)
        fp = rows.column("fp").combine_chunks()
        words = np.ascontiguousarray(as_rows(fp.to_pylist(), bits)).view("<u8")
        edges = np.array(forest(words, most, own), "i8").reshape(-1, 2)
        return pa.table({"a": fp.take(pa.array(edges[:, 0])), "b": fp.take(pa.array(edges[:, 1]))})

    return shards.place().groupBy("tree", "leaf", "lo", "hi").applyInArrow(within, "a binary, b binary").distinct()


def as_hex(fp: Column) -> Column:
    """A fingerprint of one lane as 16 lower-case hex digits of its value."""
    return F.lower(F.concat(*[F.substring(F.hex(fp), 15 - 2 * k, 2) for k in range(8)]))


def near_groups(docs: DataFrame, words: int = 4, most: int = 4, blocks: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` of every row, by Hamming distance of 64-bit fingerprints.

    ``component_id`` is the least id that can be reached over links of at most ``most`` bits.
    """
    fps = materialize(fingerprints(docs, words, 1, id_col, text_col), "fingerprints")
    with Scratch(docs.sparkSession) as write:
        nodes = write(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
        group = components(write(links(nodes.select("fp"), 64, most, blocks), "links"))
        known = nodes.join(group.hint("merge"), nodes["fp"] == group["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
        known = write(known, "known")
        least = known.groupBy("component").agg(F.min("first").alias("component_id"))
        reached = materialize(known.join(least.hint("merge"), "component").select("fp", "component_id"), "reached")
    return fps.join(reached.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def alike(fps: np.ndarray, sets: list[np.ndarray], most: int, least: float, own: int | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs at most ``most`` bits apart whose sets have that Jaccard similarity.

    Every such pair is compared unless verified pairs connect it already. With ``own``, the
    first so many rows are held against all, others not against each other.
    """
    n, out = len(sets), []
    sizes = np.array([len(x) for x in sets])
    # hashes of 20 bits say which sets may have enough in common, and are half as many bytes as the sets; these are then compared
    keys = [((x * _SPREAD) >> np.uint64(44)).astype("u4") for x in sets]
    mark, group = np.zeros(1 << 20, bool), np.arange(n)
    for i in range(min(n - 1, n if own is None else own)):
        near = np.bitwise_count(fps[i + 1 :] ^ fps[i]).sum(1, dtype="i4") <= most
        # sets whose sizes differ by more can't be alike
        near &= np.minimum(sizes[i + 1 :], sizes[i]) >= least * np.maximum(sizes[i + 1 :], sizes[i])
        others = np.flatnonzero(near & (group[i + 1 :] != group[i])) + i + 1
        if not len(others):
            continue
        mark[keys[i]] = True
        found = []
        for at in range(0, len(others), 256):
            some = others[at : at + 256]
            sums = np.concatenate([[0], np.cumsum(mark[np.concatenate([keys[j] for j in some])])])
            to = np.cumsum(sizes[some])
            common = sums[to] - sums[to - sizes[some]]
            found += some[common >= least * (sizes[some] + sizes[i] - common)].tolist()
        mark[keys[i]] = False
        found = np.array([j for j in found if _similar(sets[i], sets[j], least)], "i8")
        if len(found):
            joined, first = np.unique(group[found], return_index=True)
            out += [(i, int(j)) for j in found[first]]
            group[np.isin(group, joined)] = group[i]
    return out


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= least * (len(a) + len(b) - common)


def probes(n: int, bits: int = 256, differ: float = 0.15, recall: float = RECALL) -> list[np.ndarray]:
    """The bits of each tree's block for the links of ``n`` fingerprints whose bits differ with probability ``differ``.

    Blocks get wider as ``n`` grows, so that a leaf keeps its size, and there are as many
    of them as it takes for a link to have equal bits in one with probability ``recall``.
    """
    width = max(6, math.ceil(math.log2(max(n, 1) / NEAR_LEAF_ROWS)))
    off = np.arange(bits + 1)  # bits in which a link's fingerprints differ, and how likely so many are
    likely = np.array([math.comb(bits, d) * differ**d * (1 - differ) ** (bits - d) for d in off.tolist()])
    missed = 1 - np.prod([np.clip(bits - off - k, 0, None) / (bits - k) for k in range(width)], axis=0)  # by one tree
    trees = next(t for t in range(1, 100_000) if (likely * missed**t).sum() <= 1 - recall)
    rng = np.random.default_rng(trees)
    dealt = np.concatenate([rng.permutation(bits) for _ in range(-(-trees * width // bits))])
    return [np.unique(dealt[t * width : (t + 1) * width]) for t in range(trees)]


#: The number of the tree whose leaves are shingles.
FEW_TREE = -1


def verified_links(nodes: DataFrame, keyed: DataFrame, words: int, least: float, most: int, write: Callable) -> DataFrame:
    """``a, b``: forest edges over the pairs of ``nodes`` whose sets of shingles are alike enough.

    Nodes with a candidate are found by fingerprints alone; those of few shingles, whose fingerprints
    differ more at the same similarity, also by ``keys``, as sets that are alike share one of these. Their sets are then sent to
    the leaves where the candidates meet, and compared there before anything is reduced.
    A pair that is sure to meet in several trees asks for a leaf of the first one only. Trees
    are searched with radius 0: at this distance most balls of radius 1 cross most
    boundaries, and more trees of one leaf each find as many links with less to send.
    """
    bits = 256
    shards = Shards(nodes.select("fp"), bits, 0, probes, NEAR_LEAF_ROWS)
    radius, shared = shards.radius, shards.shared

    def meet(rows: pa.Table) -> pa.Table:
        rows, own = own_first(rows)
        fps = np.ascontiguousarray(as_rows(rows.column("fp").to_pylist(), 256))
        tree, n, found = rows.column("tree")[0].as_py(), len(fps), np.zeros(len(fps), bool)
        lanes, before = fps.view("<u8"), None
        step = max(1, 2_000_000 // n)
        for at in range(0, own, step):
            some = lanes[at : min(at + step, own)]
            d = np.bitwise_count(some[:, None, 0] ^ lanes[None, :, 0]).astype("u2")
            for w in range(1, 4):
                d += np.bitwise_count(some[:, None, w] ^ lanes[None, :, w])
            i, j = np.nonzero(d <= most)
            i, j = i[j > i + at] + at, j[j > i + at]
            if len(i) and before is None:
                before = block_values(fps, shared.value[0][:tree])
            for value in before if len(i) else ():
                new = np.bitwise_count(value[i] ^ value[j]) > radius
                i, j = i[new], j[new]
            found[i], found[j] = True, True
        return rows.select(["tree", "leaf", "own", "fp"]).filter(pa.array(found))

    schema = "tree int, leaf int, own boolean, fp binary"
    met = shards.place().groupBy("tree", "leaf", "lo", "hi").applyInArrow(meet, schema).distinct().withColumn("leaf", F.col("leaf").cast("long"))
    # sets of few shingles also meet in a leaf for each shingle of their prefixes, which is exact
    keys = nodes.select(F.explode("keys").alias("leaf"), "fp")
    shared_keys = keys.groupBy("leaf").count().filter("count > 1").select("leaf")
    short = keys.join(shared_keys, "leaf").select(F.lit(FEW_TREE).alias("tree"), "leaf", F.lit(True).alias("own"), "fp")
    met = write(met.unionByName(short), "met")
    used = nodes.join(met.select("fp").distinct(), "fp", "left_semi").select("fp", F.col("first._near_1").alias("_near_1"), F.col("first._near_2").alias("_near_2"))
    texts = keyed.join(write(used, "used"), ["_near_1", "_near_2"]).select("fp", "text")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), words)).tobytes() for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(sets, pa.binary())], names=["fp", "size", "own_set"])

    # equal rows have one key, and one set stays
    sets = texts.mapInArrow(shingled, "fp binary, size long, own_set binary").groupBy("fp").agg(F.first("size").alias("size"), F.first("own_set").alias("own_set"))
    sets = write(sets, "sets")
    # leaves of many bytes are cut into pairs of chunks
    sent = met.join(sets.select("fp", "size"), "fp")
    full = sent.groupBy("tree", "leaf").agg(F.sum(F.col("size") + 100).alias("bytes")).filter(F.col("bytes") > CHUNK_BYTES)
    chunks = full.select("tree", "leaf", F.ceil(F.col("bytes") / CHUNK_BYTES).cast("int").alias("k"))
    dealt = (
        sent.join(F.broadcast(chunks), ["tree", "leaf"], "left")  # no more than the trees have leaves
        .withColumn("k", F.coalesce("k", F.lit(1)))
        .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select("tree", "leaf", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "own", "fp")
    )

    def within(rows: pa.Table) -> pa.Table:
        rows, own = own_first(rows)
        keys = rows.column("fp").combine_chunks()
        fps = np.ascontiguousarray(as_rows(keys.to_pylist(), 256)).view("<u8")
        apart = bits if rows.column("tree")[0].as_py() == FEW_TREE else most
        edges = np.array(alike(fps, [np.frombuffer(x.as_py(), "<u8") for x in rows.column("own_set")], apart, least, own), "i8").reshape(-1, 2)
        return pa.table({"a": keys.take(pa.array(edges[:, 0])), "b": keys.take(pa.array(edges[:, 1]))})

    return dealt.join(sets.select("fp", "own_set"), "fp").groupBy("tree", "leaf", "lo", "hi").applyInArrow(within, "a binary, b binary").distinct()


def without_near_duplicates(docs: DataFrame, words: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the least id.

    Rows are linked if their sets of ``words``-word shingles have a Jaccard similarity of
    ``least`` or more; rows of equal sets are one node, other rows of equal fingerprints
    are compared like any pair. At 0.8 a bit of two fingerprints differs with probability 0.15;
    fingerprints have 256 bits here, candidates differ in 56 at most, and there are as many
    trees as find 99 % (``RECALL``) of pairs at 0.8 and more of closer ones; see
    :func:`probes`. All of these are compared exactly on whole sets,
    but for those that verified links connect already, so no row goes for less than the
    similarity. Rows without words form one group; the first of equal rows stays, and of
    rows of equal id and text the least by their other columns.
    """
    names, docs = docs.columns, plainly_named(docs, id_col, text_col)
    k1, k2 = content_key(id_col, text_col)
    keyed = docs.withColumns({"_near_1": k1, "_near_2": k2})
    with Scratch(docs.sparkSession) as write:
        rows = keyed.select(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("doc_id"), "_near_1", "_near_2").alias("_near_row"), text_col)
        fps = write(few_shingles(rows, words, least, "_near_row", text_col).toDF("row", "keys", "fp"), "fingerprints")
        nodes = write(fps.groupBy("fp").agg(F.min("row").alias("first"), F.first("keys").alias("keys")), "nodes")
        texts = keyed.select("_near_1", "_near_2", F.col(text_col).alias("text"))
        group = components(write(verified_links(nodes, texts, words, least, 56, write), "links"))
        # a set's first row, and of a group's sets the first of these, stays
        member = nodes.join(group, nodes["fp"] == group["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
        stays = member.groupBy("component").agg(F.min("first").alias("stays"))
        stays = write(member.join(stays, "component").select("fp", "stays"), "stays")
        decided = fps.join(stays, "fp")
        gone = materialize(decided.filter("row != stays").select(F.col("row._near_1").alias("_near_1"), F.col("row._near_2").alias("_near_2")), "gone")
        again = decided.filter("row = stays").groupBy(F.col("row._near_1").alias("_near_1"), F.col("row._near_2").alias("_near_2")).count().filter("count > 1").drop("count")
        again = materialize(again, "again")
    kept = keyed.join(gone, ["_near_1", "_near_2"], "left_anti")
    if not again.isEmpty():  # equal rows of which the first stays
        others = F.struct(*[F.to_json(F.struct(F.col(f"`{c}`").alias("v"))).alias(f"_{k}") for k, c in enumerate(docs.columns)])
        equal = kept.join(again, ["_near_1", "_near_2"], "left_semi").groupBy("_near_1", "_near_2").agg(F.min_by(F.struct(*[f"`{c}`" for c in docs.columns]), others).alias("_near_row"))
        equal = equal.select("_near_row.*", "_near_1", "_near_2")
        kept = kept.join(again, ["_near_1", "_near_2"], "left_anti").unionByName(equal)
    return kept.select(*docs.columns).toDF(*names)
