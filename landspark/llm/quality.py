"""Quality classifier: naive-Bayes support vectors over n-gram indicators.

A text's words (1- and 2-grams, a word and itself counting as one 2-gram) and characters (1- to 3-grams), with their case and
punctuation, are hashed into buckets; a bucket's indicator is scaled by the log-ratio of
its counts in the two classes, taken over a bounded sample of the labelled rows
(``COUNT_ROWS`` distinct rows of each class, those of the smallest hashes of id and text). A
linear hinge-loss model is fitted to unit rows of these by dual coordinate descent on
``FIT_ROWS`` of them, and its margin is turned into a probability by a logistic fit on the
same rows; each row weighs as its class does among all labelled rows. Texts become sets of
buckets, of 2 bytes each and at most 128 KB, before anything is gathered.

Null and empty texts have no n-gram: their score is that of a zero margin. Rows without a
label, id or text are not learned from; of several labels of an id the largest counts.
Repeated rows are learned from once, rows of one id and other texts each for itself. With
fewer than two classes every score is the share of label 1, or 0.5 without labels. Long
texts are read in full. Only id, text and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landspark.llm.common import Scratch, bounded_sample, content_key, small_batches
from landspark.llm.ngrams import code_points, grams

BUCKETS, SIZES = 1 << 16, (1, 2, 3)
#: Rows of each class that are counted for the ratios, and on which the margin is fitted, at most.
COUNT_ROWS, FIT_ROWS = 20_000, 2_000
_SAME = 0


def buckets(text: str | None) -> np.ndarray:
    """The distinct buckets of a text's n-grams."""
    marks = np.zeros(BUCKETS, bool)
    if text:
        for g in grams(code_points(text), SIZES, BUCKETS):
            marks[g] = True
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, text.encode("utf-8", "surrogatepass").split()), "<u8")
        marks[(words >> np.uint64(48)).astype("i8")] = True
        again = words[1:] == words[:-1]  # a word and itself: one 2-gram, and one for a third time
        marks[_SAME] |= again.any()
        marks[_SAME + 1] |= (again[1:] & again[:-1]).any()
        marks[((words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]) >> np.uint64(48)).astype("i8")] = True
    return np.nonzero(marks)[0]


def log_count_ratios(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """The ratio of every bucket and the rows of each class, over all of ``label, own`` (buckets of 2 bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rows = np.zeros((2, BUCKETS), "i8"), [0, 0]
        for b in batches:
            for y, own in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                n[y, np.frombuffer(own.as_py(), "<u2")] += 1
                rows[y] += 1
        have = np.nonzero(n.any(0))[0]
        columns = [pa.array([-1, *have], pa.int32()), *(pa.array([rows[y], *n[y, have]], pa.int64()) for y in (0, 1))]
        yield pa.record_batch(columns, names=["bucket", "n0", "n1"])

    found = rows.select("label", "own").mapInArrow(run, "bucket int, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    at = found.column("bucket").to_numpy()  # one row per bucket
    n = np.ones((2, BUCKETS + 1))
    for y in (0, 1):
        n[y, at] += found.column(f"n{y}").to_numpy()
    rows = (n[:, BUCKETS] - 1).astype(int)
    p = n[:, :BUCKETS] / n[:, :BUCKETS].sum(1, keepdims=True)
    return np.log(p[1] / p[0]), int(rows[0]), int(rows[1])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, c: np.ndarray, epochs: int = 20, seed: int = 0) -> np.ndarray:
    """Weights (the last one the bias) of the L1-loss hinge over sparse rows; ``c`` bounds each row's dual."""
    w, alpha, rng = np.zeros(size + 1), np.zeros(len(rows)), np.random.default_rng(seed)
    norms = np.array([v @ v for v in values]) + 1
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + w[size]) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), c[i])
            if (step := (new - alpha[i]) * y[i]) != 0:
                w[rows[i]] += step * values[i]
                w[size] += step
                alpha[i], moved = new, max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


def logistic(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, by Newton steps on smoothed targets."""
    n1, n0 = (weight * (y > 0)).sum(), (weight * (y <= 0)).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    ab, x = np.array([1.0, 0.0]), np.stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(ab @ x, -30, 30)))
        hessian = (x * (weight * p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x @ (weight * (target - p)))
        ab = ab + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(ab[0]), float(ab[1])


class QualityModel:
    """A fitted model: weights of indicators, already scaled, and the logistic fit."""

    def __init__(self, weights: np.ndarray, scale: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.scale, self.bias, self.slope, self.offset = weights, scale, bias, slope, offset

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
        """From all rows of ``docs`` that have a 0 or 1 in ``labels``."""
        small_batches(docs.sparkSession)
        known = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
        k1, k2 = content_key(id_col, text_col)
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), k1.alias("_k1"), k2.alias("_k2")).filter("text IS NOT NULL")
        # ids and keys are matched first, so that no text is shuffled
        keys, counts = bounded_sample(rows.select("doc_id", "_k1", "_k2").join(known, "doc_id").select("label", "_k1", "_k2"), "label", COUNT_ROWS)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                own = [buckets(t.as_py()).astype("<u2").tobytes() for t in b.column(3)]
                yield pa.record_batch([*b.columns[:3], pa.array(own, pa.binary())], names=["label", "_k1", "_k2", "own"])

        with Scratch(docs.sparkSession) as write:
            sample = rows.join(F.broadcast(keys), ["_k1", "_k2"]).groupBy("label", "_k1", "_k2").agg(F.first("text").alias("text"))  # twice COUNT_ROWS keys
            sample = write(sample.mapInArrow(cut, "label int, _k1 long, _k2 long, own binary"), "labelled")
            return cls._fit(sample, counts.get(0, 0), counts.get(1, 0))

    @classmethod
    def _fit(cls, rows: DataFrame, n0: int, n1: int) -> QualityModel:
        ratios, k0, k1 = log_count_ratios(rows)
        if not k0 or not k1:
            share = n1 / (n0 + n1) if n0 + n1 else 0.5
            return cls(np.zeros(BUCKETS), ratios, 0.0, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
        keys, _ = bounded_sample(rows.select("label", "_k1", "_k2"), "label", FIT_ROWS)
        sample = rows.join(F.broadcast(keys), ["label", "_k1", "_k2"], "left_semi").select(F.lit(0).alias("one"), "_k1", "_k2", "own", "label")
        shared = rows.sparkSession.sparkContext.broadcast(ratios)

        def fit(rows: pa.Table) -> pa.Table:
            rows, r = rows.sort_by([("_k1", "ascending"), ("_k2", "ascending"), ("label", "ascending")]), shared.value
            xs = [np.frombuffer(x.as_py(), "<u2").astype("i4") for x in rows.column("own")]
            vs = [(r[x] / max(np.linalg.norm(r[x]), 1e-12)).astype("f4") for x in xs]
            y = np.array(rows.column("label").to_pylist()) * 2 - 1
            # rows stand for those of their class, so that the sample's shares do not matter
            weight = np.where(y > 0, n1 / max(1, (y > 0).sum()), n0 / max(1, (y < 0).sum()))
            w = dual_coordinate_descent(xs, vs, y, BUCKETS, weight / weight.mean())
            margins = np.array([w[x] @ v + w[BUCKETS] for x, v in zip(xs, vs, strict=True)])
            slope, offset = logistic(margins, y, weight)
            return pa.table({"w": pa.array([w.tolist()], pa.list_(pa.float64())), "slope": [slope], "offset": [offset]})

        found = sample.groupBy("one").applyInArrow(fit, "w array<double>, slope double, offset double").first()  # a bounded sample
        w = np.array(found["w"])
        return cls(w[:BUCKETS], ratios, w[BUCKETS], found["slope"], found["offset"])

    def score(self, text: str | None) -> float:
        """The probability of label 1."""
        x = buckets(text)
        r = self.scale[x]
        margin = self.weights[x] @ r / max(np.linalg.norm(r), 1e-12) + self.bias if len(x) else 0.0
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))

    def predict(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``doc_id, score`` of every row; map-only."""
        small_batches(docs.sparkSession)
        shared = docs.sparkSession.sparkContext.broadcast(self)
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.record_batch([b.column(0), pa.array([shared.value.score(t.as_py()) for t in b.column(1)], pa.float64())], names=["doc_id", "score"])

        return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
