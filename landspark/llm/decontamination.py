"""Benchmark decontamination: SimHash of item-sized windows over every document.

For each length that benchmark items have, windows of so many words slide over a
document by one word; a document with fewer words is one window itself, if it has enough
of them to reach the threshold. A window's fingerprint is the majority bit of its shingle hashes,
taken from running sums of bits. A multi-index of the items' fingerprints finds all
items of that length within ``radius`` bits: fingerprints are cut into five blocks with a
radius each, so that two within the whole radius are within it in one block (the radii
and one for each block add up to more than the radius), and the index lists the items near
every value of every block; one in six unrelated items passes it. Candidates are then
compared exactly: the similarity of two multisets of shingles is the sum of the smaller
counts over the sum of the larger ones.

Windows without any shingle of an item of their length have similarity 0 to all of them,
so none is fingerprinted; most documents end there. At the threshold of 0.8 fingerprints
are expected to differ in 10 of 64 bits with a deviation of 3; the radius of 17 leaves
out less than one in a hundred of such pairs and none of equal passages (measured in the
tests).

A benchmark of more than ``PART_BYTES`` of text is taken in parts, which bounds what is
broadcast at once. The documents are scanned once all the same: a bitmap of a fixed size
(``SIEVE_BITS``) over the shingles of all items passes the few that may have a match, as
a window alike to an item has nearly all its shingles there, and the parts read only these.
Words are runs of ASCII letters and digits and of other
characters beyond ASCII, A-Z in lower case. Items of fewer than ``words`` words are one
shingle; items without words match nothing; null texts count as empty. Repeated
documents and repeated items give rows of their own. Only ids and texts are read; ids may
be of any type.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from landspark.llm.common import plainly_named, Scratch, content_key, materialize, small_batches

#: Bytes of items' texts in one broadcast index, about.
PART_BYTES = 8_000_000
#: Bits of the bitmap that documents are sieved by where the benchmark has more than one part.
SIEVE_BITS = 27

#: ASCII other than letters and digits separates words; A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_index: dict = {}


_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(7).integers(0, 2**64, 256, dtype="u8")
_powers: dict = {}


def folded(text: str | None) -> bytes:
    """Words in lower case, with single bytes of space between and around."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def words_of(text: str | None) -> list[bytes]:
    return folded(text).split()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2 ** 64, kept for the longest text so far."""
    if not _powers or len(_powers["up"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _powers["up"] = np.cumprod(np.full(size, np.uint64(_MULTIPLIER)))
        _powers["down"] = np.cumprod(np.full(size, np.uint64(pow(_MULTIPLIER, -1, 2**64))))
    return _powers["up"], _powers["down"]


def word_hashes(line: bytes) -> np.ndarray:
    """A hash of every word of folded bytes: a polynomial in random values of its bytes, by running sums."""
    own = np.frombuffer(line, "u1")
    inside = np.concatenate([[False], own != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(own) + 1)
    sums = np.zeros(len(own) + 1, "u8")
    np.cumsum(_BYTES[own] * up[: len(own)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of k words."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, "<u8")
    out = np.zeros(n, "<u8")
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i : i + n]
    return _mixed(out)


def majority(sums: np.ndarray, m: int) -> np.ndarray:
    """Fingerprints from rows of 64 counts of set bits."""
    return np.packbits(sums * 2 > m, axis=1, bitorder="little").view("<u8")[:, 0]


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums of set bits, from a row of zeros on."""
    bits = np.unpackbits(hashes.astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
    return np.concatenate([np.zeros((1, 64), "i4"), np.cumsum(bits, axis=0, dtype="i4")])


def similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller counts over the sum of the larger ones."""
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common / max(1, a.total() + b.total() - common)


class SameLength:
    """The items of one length in words, with the multi-index of their fingerprints."""

    BLOCKS = 5

    def __init__(self, k: int, items: list[tuple[object, list[bytes]]], radius: int):
        self.k, self.radius, self.items = k, radius, [i for i, _ in items]
        self.m = len(items[0][1]) - k + 1
        self.lines = [b" ".join(w) for _, w in items]
        hashes = [shingle_hashes(word_hashes(line), k) for line in self.lines]
        self.hashes = np.unique(np.concatenate(hashes))
        self.fps = np.concatenate([majority(h[-1:], self.m) for h in map(bit_sums, hashes)])
        cuts = np.linspace(0, 64, self.BLOCKS + 1).astype(int)
        # radii that with one for each block add up to more than the whole radius, narrow blocks first
        radii = [(radius + 1 + b) // self.BLOCKS - 1 for b in range(self.BLOCKS)]
        self.near = []  # of each block: where it begins, its mask, and for each value the items near it, as bits
        for low, high, r in zip(cuts[:-1].tolist(), cuts[1:].tolist(), radii, strict=True):
            mask = np.uint64((1 << (high - low)) - 1)
            values = ((self.fps >> np.uint64(low)) & mask).astype("u2")
            every = np.arange(1 << (high - low), dtype="u2")
            near = np.concatenate([np.packbits(np.bitwise_count(every[at : at + 1024, None] ^ values[None]) <= r, axis=1) for at in range(0, len(every), 1024)])
            self.near.append((np.uint64(low), mask, near))

    def counts(self, i: int) -> Counter:
        """The shingles of an item."""
        w = self.lines[i].split()
        return Counter(tuple(w[x : x + self.k]) for x in range(self.m))

    def possible(self, fps: np.ndarray) -> np.ndarray:
        """Windows x items that the multi-index passes."""
        found = None
        for low, mask, near in self.near:
            own = near[(fps >> low) & mask]
            found = own if found is None else found | own
        return np.unpackbits(found, axis=1, count=len(self.fps))

    def candidates(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items within the radius."""
        w, i = np.nonzero(self.possible(fps))
        close = np.bitwise_count(fps[w] ^ self.fps[i]) <= self.radius
        return w[close], i[close]


class BenchmarkIndex:
    """Fingerprints of a part of the benchmark, by length."""

    def __init__(self, items: list[tuple[object, str]], words: int, radius: int):
        by_length = defaultdict(list)
        for item, text in items:
            if split := words_of(text):
                by_length[len(split)].append((item, split))
        self.lengths = {n: SameLength(min(words, n), own, radius) for n, own in sorted(by_length.items())}
        self.sieve = {}  # for each shingle length, the low bits of the items' hashes, and the hashes
        for k in {one.k for one in self.lengths.values()}:
            every = np.unique(np.concatenate([one.hashes for one in self.lengths.values() if one.k == k]))
            low = np.zeros(1 << 22, bool)
            low[every & np.uint64((1 << 22) - 1)] = True
            self.sieve[k] = low, every

    def matches(self, text: str | None, least: float) -> Iterator[tuple[object, float, int, int]]:
        """``item, similarity, first word, words`` of the best window of each item found."""
        line = folded(text)
        own = word_hashes(line)
        hashes, sums = {}, {}
        for k, (low, every) in self.sieve.items():
            h = shingle_hashes(own, k)
            maybe = h[low[h & np.uint64((1 << 22) - 1)]]
            if (every[np.minimum(np.searchsorted(every, maybe), len(every) - 1)] == maybe).any():
                hashes[k] = h
        if not hashes:
            return
        words = line.split()
        for one in self.lengths.values():
            # a document shorter than the item is one window, if it can be alike enough
            m = min(one.m, len(words) - one.k + 1)
            if one.k not in hashes or m / one.m < least:
                continue
            h = hashes[one.k]
            shared = np.concatenate([[0], np.cumsum(one.hashes[np.minimum(np.searchsorted(one.hashes, h), len(one.hashes) - 1)] == h)])
            starts = np.nonzero(shared[m:] > shared[:-m])[0]
            if not len(starts):
                continue
            if one.k not in sums:
                sums[one.k] = bit_sums(h)
            best = {}
            step = max(1, 20_000_000 // len(one.fps))
            for at in range(0, len(starts), step):
                some = starts[at : at + step]
                for w, i in zip(*one.candidates(majority(sums[one.k][some + m] - sums[one.k][some], m)), strict=True):
                    s = int(some[w])
                    got = similarity(Counter(tuple(words[x : x + one.k]) for x in range(s, s + m)), one.counts(i))
                    if got >= least and got > best.get(i, (0,))[0]:
                        best[i] = (got, s)
            for i, (got, s) in best.items():
                yield one.items[i], got, s, m + one.k - 1


class _Part:
    """A part of the benchmark, sent to every worker, which indexes it once."""

    def __init__(self, items, words: int, radius: int):
        self.items, self.words, self.radius, self.key = items, words, radius, uuid.uuid4().hex

    def index(self) -> BenchmarkIndex:
        if self.key not in _index:
            _index.clear()
            _index[self.key] = BenchmarkIndex(self.items.value, self.words, self.radius)
        return _index[self.key]


class Sieve:
    """A bitmap of the shingle hashes of all items, and the lengths that items have."""

    def __init__(self, benchmark: DataFrame, words: int, least: float):
        width = self.width = SIEVE_BITS

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            marks, lengths = np.zeros(1 << width, bool), set()
            for b in batches:
                for t in b.column(0):
                    own = word_hashes(folded(t.as_py()))
                    if len(own):
                        lengths.add(len(own))
                        marks[shingle_hashes(own, min(words, len(own))) >> np.uint64(64 - width)] = True
            rows = np.packbits(marks).reshape(-1, 1024)
            have = np.flatnonzero(rows.any(axis=1))
            for n in lengths:
                yield pa.record_batch([pa.array([-n], pa.int32()), pa.array([b""], pa.binary())], names=["at", "bits"])
            if len(have):
                yield pa.record_batch([pa.array(have, pa.int32()), pa.array([rows[k].tobytes() for k in have], pa.binary())], names=["at", "bits"])

        def union(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            every = [np.frombuffer(x.as_py(), "u1") for x in rows.column("bits")]
            return pa.table({"at": rows.column("at").slice(0, 1), "bits": pa.array([np.bitwise_or.reduce(every).tobytes()], pa.binary())})

        small_batches(benchmark.sparkSession)
        found = benchmark.select("text").mapInArrow(run, "at int, bits binary").groupBy("at").applyInArrow(union, "at int, bits binary").collect()  # the bitmap and one row per length
        self.words, self.bits = words, np.zeros((1 << width) // 8, "u1").reshape(-1, 1024)
        for r in found:
            if r["at"] >= 0:
                self.bits[r["at"]] = np.frombuffer(bytes(r["bits"]), "u1")
        self.bits, self.least = self.bits.reshape(-1), least
        self.sizes = sorted({(min(words, -r["at"]), -r["at"] - min(words, -r["at"]) + 1) for r in found if r["at"] < 0})

    def passes(self, text: str | None) -> bool:
        """Whether a window of the text may be alike enough to an item."""
        own, hits = word_hashes(folded(text)), {}
        for k, m in self.sizes:
            if len(own) < k:
                continue
            if k not in hits:
                at = (shingle_hashes(own, k) >> np.uint64(64 - self.width)).astype("i8")
                hits[k] = np.concatenate([[0], np.cumsum((self.bits[at >> 3] >> (7 - (at & 7)).astype("u1")) & 1, dtype="i8")])
            n = min(m, len(hits[k]) - 1)
            # similarity s of windows of n and m shingles takes s / (1 + s) of n + m in common
            if n >= self.least * m and (hits[k][n:] - hits[k][:-n]).max() >= self.least / (1 + self.least) * (n + m) - 1e-9:
                return True
        return False


def sieved(docs: DataFrame, sieve: Sieve, text_col: str) -> DataFrame:
    """The rows of ``docs`` that may have a match; map-only."""
    shared, at = docs.sparkSession.sparkContext.broadcast(sieve), docs.columns.index(text_col)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([shared.value.passes(t.as_py()) for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _part(benchmark: DataFrame, n: int, k: int, words: int, radius: int) -> _Part:
    """Part ``k`` of ``n`` of the benchmark; nothing else of it is on the driver at once."""
    own = benchmark if n == 1 else benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
    items = [(r["item_id"], r["text"]) for r in own.select("item_id", "text").collect()]
    return _Part(benchmark.sparkSession.sparkContext.broadcast(items), words, radius)


def contaminated(docs: DataFrame, benchmark: DataFrame, words: int = 5, least: float = 0.8, radius: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_words``: the best window of each item in each document.

    Pairs below the similarity ``least`` and documents without a pair have no row. The
    documents are read in place and once; nothing is shuffled.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    item = benchmark.schema["item_id"].dataType
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, item_id {item.simpleString()}, similarity double, first_word long, n_words long"
    item_type = to_arrow_type(item)

    def found(rows: DataFrame, part: _Part) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = part.index()
            for b in batches:
                hits = [(k, *hit) for k, t in enumerate(b.column(1)) for hit in index.matches(t.as_py(), least)]
                if hits:
                    row, own, score, first, n = zip(*hits, strict=True)
                    yield pa.record_batch([b.column(0).take(pa.array(row)), pa.array(own, item_type), pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        return rows.mapInArrow(run, schema)

    n = max(1, -(-int(benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES))
    if n == 1:
        return found(rows, _part(benchmark, 1, 0, words, radius))
    with Scratch(docs.sparkSession) as write:
        rows, out = write(sieved(rows, Sieve(benchmark, words, least), "text"), "sieved"), []
        for k in range(n):  # one part is on the driver and on its way at once
            part = _part(benchmark, n, k, words, radius)
            out.append(materialize(found(rows, part), "found"))
            part.items.destroy()
    return reduce(DataFrame.union, out)


def decontaminated(docs: DataFrame, benchmark: DataFrame, words: int = 5, least: float = 0.8, radius: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any window that is alike enough to an item; map-only for a benchmark of one part.

    For more parts, the sieved rows with a match are found first and taken out by two
    hashes of id and text.
    """
    small_batches(docs.sparkSession)
    n = max(1, -(-int(benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES))
    if n > 1:
        names, docs = docs.columns, plainly_named(docs, id_col, text_col)
        k1, k2 = content_key(id_col, text_col)
        keyed = docs.withColumns({"_bench_1": k1, "_bench_2": k2})
        hits = contaminated(keyed.select(F.struct("_bench_1", "_bench_2").alias("key"), F.col(text_col).alias("text")), benchmark, words, least, radius, "key")
        gone = materialize(hits.select("doc_id._bench_1", "doc_id._bench_2").distinct(), "gone")
        return keyed.join(gone, ["_bench_1", "_bench_2"], "left_anti").select(*docs.columns).toDF(*names)
    at, part = docs.columns.index(text_col), _part(benchmark, 1, 0, words, radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = part.index()
        for b in batches:
            yield b.filter(pa.array([next(index.matches(t.as_py(), least), None) is None for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
