import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landspark.llm import language_id, ngrams, quality
from landspark.llm.queries import op3_quality, op4_language_id
from tests.llm.helpers import LONG, awkward, documents

SF = "/root/testdata/sf0.01"


def test_held_out_language_accuracy(spark):
    got = op4_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all() and not got.rejected.any()
    own = got[got.held_out]
    assert len(own) > 150 and (own.lang == own.lang_pred).mean() > 0.97


def test_held_out_quality(spark):
    got = op3_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    own = got[got.held_out & got.quality.notna()]
    good, bad = own[own.quality == 1].score, own[own.quality == 0].score
    assert (good.to_numpy()[:, None] > bad.to_numpy()).mean() > 0.95 and (own.quality == own.predicted).mean() > 0.9


def test_language_of_awkward_rows(spark):
    df = awkward(spark)
    model = language_id.LanguageModel.fit(df)
    got = model.predict(df)
    assert got.columns == [c for c in df.columns if c != "lang_pred"] + ["lang_pred", "lang_score", "lang_rejected"]
    by = {r["doc_id"]: r for r in got.collect()}
    for i in (2, 3, 4, 9):
        assert by[i]["lang_pred"] == "und" and by[i]["lang_score"] == 0 and by[i]["lang_rejected"]
    assert by[8]["lang_pred"] == "fr" and by[1]["lang_pred"] == "en" and 0 < by[5]["lang_score"] <= 1


def test_far_texts_are_rejected(spark):
    model = language_id.LanguageModel.fit(documents(spark, ["the cat sat on the mat and slept", "a dog ran in the park today"]))
    got = {r["doc_id"]: r["lang_rejected"] for r in model.predict(documents(spark, ["the cat ran", "щука плывёт по реке", "漢字漢字"])).collect()}
    assert got == {0: False, 1: True, 2: True}


def test_long_foreign_and_garbled_texts_are_rejected_and_short_clean_ones_stay(spark):
    rng = random.Random(0)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.LanguageModel.fit(docs.filter(~ngrams.held_out()))
    polish = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa".split()
    garbled = lambda own, n: " ".join("".join(rng.choice(own) for _ in range(rng.randint(2, 9))) for _ in range(n))
    far = [f(n) for n in (100, 1000, 5000) for f in (lambda n: garbled("abcdefghijklmnopqrstuvwxyz", n), lambda n: garbled("абвгдежзийклмнопрстуфхцчшщъыьэюя", n), lambda n: " ".join(rng.choice(polish) for _ in range(n)))]
    near = [r["text"][:n] for r in docs.filter(ngrams.held_out() & F.col("text").rlike("[a-z]{3}")).orderBy("doc_id").limit(40).collect() for n in (40, 400)]
    got = {r["doc_id"]: (r["lang_rejected"], r["lang_score"]) for r in model.predict(documents(spark, far + near)).collect()}
    assert all(got[k][0] for k in range(len(far))) and max(got[k][1] for k in range(len(far))) > 0.2
    assert sum(got[k][0] for k in range(len(far), len(got))) <= 1


def test_models_without_training_rows(spark):
    none, some = documents(spark, []), documents(spark, ["a", None])
    assert [r["lang_pred"] for r in language_id.LanguageModel.fit(none).predict(some).collect()] == ["und", "und"]
    assert language_id.LanguageModel.fit(some).predict(none).count() == 0
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    assert [r["score"] for r in quality.QualityModel.fit(none, labels, "quality").predict(some).collect()] == [pytest.approx(0.5)] * 2
    assert all(r["score"] > 0.99 for r in quality.QualityModel.fit(some, labels, "quality").predict(some).collect())


def test_quality_of_awkward_rows(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, 1), (6, 0), (7, None), (8, 7), (None, 1), (77, 0)], "doc_id long, quality int")
    got = quality.QualityModel.fit(df, labels, "quality").predict(df).collect()
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 for r in got)


def test_pieces_of_long_texts_give_the_same_grams(monkeypatch):
    points = ngrams.folded(LONG[:5000])
    whole = [np.concatenate(list(ngrams.grams(points, (n,), 4096))) for n in (1, 2, 3)]
    monkeypatch.setattr(ngrams, "PIECE", 97)
    assert [sorted(np.concatenate(list(ngrams.grams(points, (n,), 4096)))) for n in (1, 2, 3)] == [sorted(w) for w in whole]
    assert [len(w) for w in whole] == [len(points) - n for n in (0, 1, 2)]


def test_dual_coordinate_descent_reaches_the_primal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 5))
    y = np.where(x @ [1, -2, 0, 0.5, 0] + 0.3 * rng.normal(size=80) > 0, 1, -1)
    c = np.full(80, 0.5)
    w = quality.dual_coordinate_descent([np.arange(5)] * 80, list(x), y, 5, c, epochs=2000)
    xb = np.hstack([x, np.ones((80, 1))])
    primal = lambda v: 0.5 * v @ v + (c * np.maximum(0, 1 - y * (xb @ v))).sum()
    best = np.zeros(6)
    for k in range(1, 20_001):  # subgradient descent
        bad = y * (xb @ best) < 1
        best = best - (best - (c * y * bad) @ xb) / (k + 10)
    assert primal(w) <= primal(best) * 1.001


def test_spherical_k_means_finds_clusters():
    rng = np.random.default_rng(0)
    x = np.abs(np.repeat(np.eye(6)[:3], 50, 0) + 0.05 * rng.normal(size=(150, 6)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert ((x @ language_id.spherical_k_means(x, 3, seed=1).T).max(1) > 0.6).all()


def test_a_repeated_id_is_sampled_by_rows(spark, monkeypatch):
    monkeypatch.setattr(language_id, "FIT_ROWS", 50)
    monkeypatch.setattr(quality, "COUNT_ROWS", 50)
    monkeypatch.setattr(quality, "FIT_ROWS", 40)
    rng = random.Random(2)
    text = lambda own: " ".join(rng.choice(own) for _ in range(12))
    english, french = "the a of with house garden dog tree".split(), "le une de avec maison jardin chien arbre".split()
    rows = [(7, text(english), "en") for _ in range(400)] + [(None, text(french), "fr") for _ in range(300)] + [(9, "le même texte", "fr")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.LanguageModel.fit(df)
    assert model.languages == ["en"] * 4 + ["fr"] * 4
    assert [model.nearest(t)[0] for t in ("the house of the dog", "avec une maison de chien")] == ["en", "fr"]
    labels = spark.createDataFrame([(7, 1), (9, 0), (3, 0)], "doc_id long, quality int")
    more = df.unionByName(spark.createDataFrame([(3, text(french), "fr") for _ in range(200)], df.schema))
    scorer = quality.QualityModel.fit(more, labels, "quality")
    assert scorer.score("the house of the dog") > 0.5 > scorer.score("avec une maison de chien")


def test_sample_bounds(spark):
    from landspark.llm.common import bounded_sample

    df = spark.range(20_000).select(F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("by"), (F.col("id") % 5000 * 7919).alias("_k1"), F.lit(1).cast("long").alias("_k2"))
    keys, counts = bounded_sample(df, "by", 1000)
    assert counts == {"a": 5000, "b": 15000} and {r["by"]: r["count"] for r in keys.groupBy("by").count().collect()} == {"a": 1000, "b": 1000}
    assert keys.distinct().count() == 2000


def slow_buckets(points, n, buckets):
    """Buckets of n-grams, one by one in whole numbers."""
    out, mask = [], 2**64 - 1
    for at in range(len(points) - n + 1):
        h = n
        for k in range(n):
            h = ((h ^ int(points[at + k])) * int(ngrams._PRIMES[k])) & mask
            h ^= h >> 29
        out.append(((h * int(ngrams._PRIMES[3])) & mask) >> (64 - buckets.bit_length() + 1))
    return out


def test_language_against_brute_force(spark):
    """Frequencies, vectors, the nearest centroid and the limits, by plain loops."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model, rows = language_id.LanguageModel.fit(docs.filter(~ngrams.held_out())), docs.collect()
    held = {r["doc_id"] for r in docs.filter(ngrams.held_out()).collect()}

    def counted(text):
        found = {}
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        points = [ord(c) for c in " " + " ".join(words) + " "] if words else []
        for n in (1, 2, 3):
            for b in slow_buckets(points, n, 4096):
                found[b] = found.get(b, 0) + 1
        return found, len(points)

    every = {r["doc_id"]: counted(r["text"] or "") for r in rows}
    training = [r["doc_id"] for r in rows if r["doc_id"] not in held and r["text"] is not None and r["lang"] is not None and every[r["doc_id"]][0]]
    df = {}
    for i in training:
        for b in every[i][0]:
            df[b] = df.get(b, 0) + 1
    for b in range(4096):
        assert model.idf[b] == pytest.approx(np.log((1 + len(training)) / (1 + df.get(b, 0))) + 1)
    got = {r["doc_id"]: r for r in model.predict(docs).collect()}
    for i, (found, length) in every.items():
        if not found:
            assert got[i]["lang_pred"] == "und"
            continue
        v = {b: np.log1p(n) * model.idf[b] for b, n in found.items()}
        norm = sum(x * x for x in v.values()) ** 0.5
        cosines = [sum(float(c[b]) * x for b, x in v.items()) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=lambda k: (round(cosines[k], 6), -k))
        assert got[i]["lang_score"] == pytest.approx(max(cosines), abs=1e-4)
        if sorted(cosines)[-2] < max(cosines) - 1e-5:
            limit = max(0.1, model.limits[best][min(max(length.bit_length() - 1, 2), 8) - 2])
            assert got[i]["lang_pred"] == model.languages[best] and (got[i]["lang_rejected"] == (max(cosines) < limit) or abs(max(cosines) - limit) < 1e-4)


def test_quality_against_brute_force(spark):
    """Ratios, and scores by the fitted weights, by plain loops; the fit itself against the best of its objective."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model, rows = quality.QualityModel.fit(docs, labels, "quality"), docs.collect()
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}

    def own(text):
        import xxhash

        found = {b for n in (1, 2, 3) for b in slow_buckets([ord(c) for c in text], n, 1 << 16)}
        words = [xxhash.xxh3_64_intdigest(w) for w in text.encode().split()]
        found |= {w >> 48 for w in words} | {((a * 0x9E3779B97F4A7C15 + b) % 2**64) >> 48 for a, b in zip(words, words[1:], strict=False)}
        same = [a == b for a, b in zip(words, words[1:], strict=False)]
        return found | ({0} if any(same) else set()) | ({1} if any(a and b for a, b in zip(same, same[1:], strict=False)) else set())

    features = {r["doc_id"]: own(r["text"] or "") for r in rows}
    seen = {(r["doc_id"], r["text"]): known[r["doc_id"]] for r in rows if r["doc_id"] in known and r["text"] is not None}
    n = np.ones((2, 1 << 16))
    for (i, _), y in seen.items():
        n[y, list(features[i])] += 1
    p = n / n.sum(1, keepdims=True)
    assert np.allclose(model.scale, np.log(p[1] / p[0]))
    got = {r["doc_id"]: r["score"] for r in model.predict(docs).collect()}
    for i, x in features.items():
        r = np.array([model.scale[b] for b in x])
        margin = sum(model.weights[b] * model.scale[b] for b in x) / max(np.linalg.norm(r), 1e-12) + model.bias if x else 0.0
        assert got[i] == pytest.approx(1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -30, 30))), abs=1e-9)


def test_held_out_rule(spark):
    import zlib

    df = spark.range(200).select(F.col("id").alias("doc_id"))
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in df.withColumn("h", ngrams.held_out()).collect())
