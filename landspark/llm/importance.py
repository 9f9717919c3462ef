"""Importance resampling towards a target by hashed n-grams of words.

A text is lower-cased (A-Z only) and every run of separators becomes one space. A pattern of
n words that must not touch another character than a space on either side is then found at
every place, overlaps included, so that its spans are the n-grams; the CRC-32 of a span
picks its bucket. Both corpora are counted whole, by bucket, and a document's weight is the
sum of its features' log-ratio gains, in thousandths. Documents are drawn by weight and
Gumbel noise, which is sampling without replacement in proportion to the ratio.

Texts are scanned once: the buckets of a document, two bytes a feature, are written in the
shared folder, and both the counts and the weights are made from these. Each task counts into one array
of buckets and returns it once, so what is shuffled are a partition's counts and never
features; gains are one number per bucket.

A null or blank text has no feature and weight 0. An empty corpus has zero counts. Repeated
rows are weighed alike, and drawn as the rows they are. A null id takes part like others and
comes first among equal scores. Only id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landspark.functions.row_ids import numbered
from landspark.llm.common import Scratch, materialize, small_batches

#: A-Z to a-z, other ASCII characters than digits and letters to spaces.
_FOLD = bytes(c | 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_SPACES = re.compile(rb"  +")


def spans_of(n: int) -> regex.Pattern:
    """Matches n words with a boundary on either side; to be searched with overlaps."""
    return regex.compile(rb"(?<![^ ])[^ ]+" + rb" [^ ]+" * (n - 1) + rb"(?![^ ])")


def features(clean: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """The buckets of all n-grams of a text whose separators are single spaces, in 16 bits where they fit."""
    crcs = np.fromiter((zlib.crc32(m[0]) for p in patterns for m in p.finditer(clean, overlapped=True)), "<u4")
    return (crcs % buckets).astype("<u2" if buckets <= 1 << 16 else "<u4")


class Resampler:
    """Weighs and draws documents of one corpus by how alike they are to another.

    Features are the runs of ``sizes`` words, from the first number to the second.
    """

    def __init__(self, sizes: tuple[int, int] = (1, 1), buckets: int = 10_000):
        self.sizes, self.buckets = sizes, buckets
        self.kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def hashed(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``doc_id, n_words, features``: the buckets of each text's n-grams as packed integers; map-only."""
        small_batches(docs.sparkSession)
        sizes, buckets = self.sizes, self.buckets

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            patterns = [spans_of(n) for n in range(sizes[0], sizes[1] + 1)]
            for rows in batches:
                words, found = [], []
                for text in rows.column(1):
                    clean = _SPACES.sub(b" ", (text.as_py() or "").encode("utf-8", "replace").translate(_FOLD)).strip(b" ")
                    words.append(clean.count(b" ") + 1 if clean else 0)
                    found.append(features(clean, patterns, buckets).tobytes())
                yield pa.record_batch([rows.column(0), pa.array(words, pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "n_words", "features"])

        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        return rows.mapInArrow(scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, features binary")

    def counts(self, hashed: DataFrame) -> DataFrame:
        """``bucket, n``: how many features of all texts are in each bucket that has any."""
        kind, buckets = self.kind, self.buckets

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(buckets, "i8")
            for rows in batches:
                for packed in rows.column(0):
                    total += np.bincount(np.frombuffer(packed.as_buffer(), kind), minlength=buckets)
            used = np.nonzero(total)[0]
            yield pa.record_batch([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

        return hashed.select("features").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))

    def gains(self, raw: DataFrame, target: DataFrame) -> list[int]:
        """A gain for each bucket, of two hashed corpora; two numbers per bucket reach the driver."""
        n = np.zeros((2, self.buckets))
        both = self.counts(raw).withColumn("side", F.lit(0)).unionByName(self.counts(target).withColumn("side", F.lit(1)))
        for r in both.collect():
            n[r["side"], r["bucket"]] = r["n"]
        (s, t), (all_s, all_t) = n.tolist(), (n.sum(axis=1) + self.buckets).tolist()
        return [math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t, strict=True)]

    def weigh(self, hashed: DataFrame, gains: list[int]) -> DataFrame:
        """``doc_id, n_words, n_features, weight`` of every document, map-only."""
        kind = self.kind
        shared = hashed.sparkSession.sparkContext.broadcast(np.array(gains, "i8"))  # one number per bucket

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for rows in batches:
                found = [np.frombuffer(packed.as_buffer(), kind) for packed in rows.column(2)]
                sums = [pa.array([f(x) for x in found], pa.int64()) for f in (len, lambda x: int(own[x].sum()))]
                yield pa.record_batch([rows.column(0), rows.column(1), *sums], names=["doc_id", "n_words", "n_features", "weight"])

        return hashed.mapInArrow(weigh, f"doc_id {hashed.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")

    def resample(self, docs: DataFrame, target: DataFrame, percent: int = 10, seed: int = 2024, least: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """:func:`draw` of ``docs``, by their weights towards ``target``."""
        with Scratch(docs.sparkSession) as write:
            own = write(self.hashed(docs, id_col, text_col), "features")
            gains = self.gains(own, self.hashed(target.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text"))))
            weighed = materialize(self.weigh(own, gains), "weights")
        return draw(weighed, percent, seed, least)


def draw(weighed: DataFrame, percent: int = 10, seed: int = 2024, least: int = 20) -> DataFrame:
    """Adds ``score`` and ``rank``: 1, 2, ... of the drawn documents, null for others.

    Of the documents with at least ``least`` words that share of ``percent`` is drawn that has the highest
    scores, ties going to smaller ids. Ranks come from range partitions, so no task orders them all.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    scored = weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))))
    long, short = scored.filter(F.col("n_words") >= least), scored.filter(F.col("n_words") < least)
    ranked = numbered(long.withColumn("_last", -F.col("score")), ["_last", "doc_id", "n_features", "weight"], "rank")
    drawn = percent * ranked.count() // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("_last")
    return ranked.unionByName(short.withColumn("rank", F.lit(None).cast("long")))
