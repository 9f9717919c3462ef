"""Language identification by nearest centroids of normalised TF-IDF n-gram vectors.

A text is lower-cased, everything but letters becomes a space, and its character n-grams
(1 to 3) are counted in hashed buckets. Document frequencies come from all training
documents. Each language gets several centroids by spherical k-means over a bounded
sample (``FIT_ROWS`` distinct rows of it, those of the smallest hashes of id and text); texts
become sparse vectors, of a bounded size, before a language's are gathered. A text takes the
language of the centroid with the largest cosine; the score is that cosine. It is
rejected if the cosine is below ``reject_below`` or below the limit of that language for
texts of its length, i.e. if it is far from every centroid.

Unrelated texts reach more cosine the longer they are, so limits go by length. Each half
of a language's sample is measured by centroids of the other half, on prefixes of each
text that double in length up to ``2 ** LONGEST`` letters, and on the whole text; the limit
of a length is ``MARGIN`` times the ``LOWEST`` quantile of these cosines. Texts of ``2 ** LONGEST``
letters or more are one class. A class without measurements has no limit but ``reject_below``.

A null text, or one without a letter, is ``und`` with score 0 and rejected. Documents with
a null language or text are not learned from; a null id is an id like any other. Ties go to
the language that comes first. Without training documents every text is ``und``. Repeated
rows count as often as they come in document frequencies, and once in the sample; rows of
one id and other texts are rows of their own. Only id, text and language are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landspark.llm.common import bounded_sample, content_key, small_batches
from landspark.llm.ngrams import folded, grams

SIZES, BUCKETS = (1, 2, 3), 4096
#: Documents of each language on which its centroids are fitted, at most.
FIT_ROWS = 1_000
CENTROIDS = 4
#: Limits of rejection: quantile of cosines, share of it, and the powers of two of letters that are told apart.
LOWEST, MARGIN, SHORTEST, LONGEST = 0.005, 0.8, 2, 8
#: Documents of each language on which limits are measured, at most.
LIMIT_ROWS = 400
UNKNOWN = "und"


def counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams, or None if the text has no letter."""
    points = folded(text or "")
    if len(points) < 2:
        return None
    out = np.zeros(BUCKETS)
    for g in grams(points, SIZES, BUCKETS):
        out += np.bincount(g, minlength=BUCKETS)
    return out


def weighted(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The normalised TF-IDF vector of counts."""
    found = np.log1p(found) * idf
    return found / max(np.linalg.norm(found), 1e-12)


def vector(text: str | None, idf: np.ndarray) -> np.ndarray | None:
    """The normalised TF-IDF vector."""
    found = counts(text)
    return None if found is None else weighted(found, idf)


def document_frequencies(training: DataFrame, text_col: str = "text") -> np.ndarray:
    """Inverse document frequencies of all buckets over all training documents."""
    small_batches(training.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS, "i8"), 0
        for b in batches:
            for t in b.column(0):
                if (c := counts(t.as_py())) is not None:
                    df, n = df + (c > 0), n + 1
        have = np.nonzero(df)[0]
        yield pa.record_batch([pa.array([-1, *have], pa.int32()), pa.array([n, *df[have]], pa.int64())], names=["bucket", "n"])

    found = training.select(text_col).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    by_bucket = {r["bucket"]: r["n"] for r in found.collect()}  # one number per bucket
    df = np.array([by_bucket.get(k, 0) for k in range(BUCKETS)], float)
    return np.log((1 + by_bucket.get(-1, 0)) / (1 + df)) + 1


def spherical_k_means(x: np.ndarray, k: int, rounds: int = 20, seed: int = 0) -> np.ndarray:
    """Unit centroids of unit rows; an emptied cluster is left out."""
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        new = np.array([x[own == c].sum(0) for c in range(len(centres)) if (own == c).any()])
        new /= np.linalg.norm(new, axis=1, keepdims=True)
        if new.shape == centres.shape and np.allclose(new, centres):
            break
        centres = new
    return centres


def length_class(text: str | None) -> int:
    """The power of two of the text's folded length, from ``SHORTEST`` to ``LONGEST``."""
    return min(max(len(folded(text or "")).bit_length() - 1, SHORTEST), LONGEST) - SHORTEST


def sparse(text: str) -> bytes:
    """Buckets and counts of a text, 6 bytes for each bucket that it has."""
    found = counts(text)
    have = np.zeros(0, "i8") if found is None else np.flatnonzero(found)
    return have.astype("<u2").tobytes() + (b"" if found is None else found[have].astype("<f4").tobytes())


def dense(raw: bytes) -> np.ndarray:
    """Counts of all buckets."""
    n, out = len(raw) // 6, np.zeros(BUCKETS)
    out[np.frombuffer(raw, "<u2", n)] = np.frombuffer(raw, "<f4", n, 2 * n)
    return out


def prefixes(text: str) -> list[str]:
    """The prefixes on which limits are measured, and the whole text at the end."""
    return [text[: 1 << k] for k in range(SHORTEST, LONGEST + 1) if 1 << k < len(text)] + [text]


def length_limits(rows: list[list[tuple[int, np.ndarray]]]) -> np.ndarray:
    """The least cosine of each length class, 0 where nothing is measured.

    A row has ``length class, vector`` of each prefix, the whole text at the end; each half
    of the rows is measured by the other.
    """
    found: list[list[float]] = [[] for _ in range(LONGEST - SHORTEST + 1)]
    halves = rows[::2], rows[1::2]
    for own, other in (halves, halves[::-1]):
        if not other:
            continue
        centres = spherical_k_means(np.array([row[-1][1] for row in other], "f4"), CENTROIDS)
        for row in own[: LIMIT_ROWS // 2]:
            for k, v in row:
                found[k].append(float((centres @ v.astype("f4")).max()))
    return np.array([MARGIN * np.quantile(x, LOWEST) if x else 0.0 for x in found])


class LanguageModel:
    """Centroids of the learned languages, with the limits of each one's language by length."""

    def __init__(self, idf: np.ndarray, languages: list[str], centroids: np.ndarray, limits: np.ndarray):
        self.idf, self.languages, self.centroids, self.limits = idf, languages, centroids.astype("f4"), limits

    @classmethod
    def fit(cls, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
        k1, k2 = content_key(id_col, text_col)
        rows = training.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), k1.alias("_k1"), k2.alias("_k2")).filter("text IS NOT NULL AND lang IS NOT NULL")
        idf = document_frequencies(rows)
        keys, _ = bounded_sample(rows.select("lang", "_k1", "_k2"), "lang", FIT_ROWS)
        sample = rows.join(F.broadcast(keys), ["lang", "_k1", "_k2"]).groupBy("lang", "_k1", "_k2").agg(F.first("text").alias("text"))
        shared = training.sparkSession.sparkContext.broadcast(idf)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                parts = [[p for p in prefixes(t.as_py()) if len(folded(p)) > 1] for t in b.column(3)]
                classes = pa.array([[length_class(p) for p in own] for own in parts], pa.list_(pa.int32()))
                yield pa.record_batch([*b.columns[:3], classes, pa.array([[sparse(p) for p in own] for own in parts], pa.list_(pa.binary()))], names=["lang", "_k1", "_k2", "classes", "counts"])

        def fit(key: tuple, rows: pa.Table) -> pa.Table:
            rows = rows.sort_by([("_k1", "ascending"), ("_k2", "ascending")])
            own = [[(k, weighted(dense(c), shared.value)) for k, c in zip(ks, cs, strict=True)] for ks, cs in zip(rows.column("classes").to_pylist(), rows.column("counts").to_pylist(), strict=True) if ks]
            limits = length_limits(own).tolist()
            centres = spherical_k_means(np.array([row[-1][1] for row in own], "f4"), CENTROIDS) if own else np.zeros((0, BUCKETS))
            return pa.table({"lang": pa.array([key[0].as_py()] * len(centres), pa.string()), "centroid": pa.array([c.tolist() for c in centres], pa.list_(pa.float64())), "limits": pa.array([limits] * len(centres), pa.list_(pa.float64()))})

        counted = sample.mapInArrow(count, "lang string, _k1 long, _k2 long, classes array<int>, counts array<binary>")
        found = counted.groupBy("lang").applyInArrow(fit, "lang string, centroid array<double>, limits array<double>").collect()  # a few rows per language
        found.sort(key=lambda r: r["lang"])
        limits = np.array([r["limits"] for r in found]).reshape(-1, LONGEST - SHORTEST + 1)
        return cls(idf, [r["lang"] for r in found], np.array([r["centroid"] for r in found]).reshape(-1, BUCKETS), limits)

    def nearest(self, text: str | None) -> tuple[str, float, float]:
        """The language, the cosine, and the limit below which a text of this length is rejected."""
        v = vector(text, self.idf)
        if v is None or not len(self.centroids):
            return UNKNOWN, 0.0, 0.0
        scores = self.centroids @ v.astype("f4")
        best = int(np.argmax(scores))
        return self.languages[best], float(min(1.0, max(0.0, scores[best]))), float(self.limits[best, length_class(text)])

    def predict(self, docs: DataFrame, reject_below: float = 0.1, text_col: str = "text") -> DataFrame:
        """``docs`` with ``lang_pred, lang_score, lang_rejected`` behind their columns; map-only.

        Columns of these names are replaced.
        """
        docs = docs.drop("lang_pred", "lang_score", "lang_rejected")
        small_batches(docs.sparkSession)
        shared = docs.sparkSession.sparkContext.broadcast(self)
        at = docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [shared.value.nearest(t.as_py()) for t in b.column(at)]
                names, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
                rejected = pa.array([f[0] == UNKNOWN or f[1] < max(reject_below, f[2]) for f in found], pa.bool_())
                yield pa.RecordBatch.from_arrays([*b.columns, names, scores, rejected], names=[*b.schema.names, "lang_pred", "lang_score", "lang_rejected"])

        schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_rejected", T.BooleanType())])
        return docs.mapInArrow(run, schema)
