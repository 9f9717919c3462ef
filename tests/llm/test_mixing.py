import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from landspark.llm import mixing
from landspark.llm.common import materialize
from tests.llm.helpers import awkward, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """Resharing the excess again and again; sizes in source order."""
    w = [weights[k % len(weights)] for k in range(len(sizes))]
    full: set[int] = set()
    while True:
        left = share * sum(sizes) - sum(most * sizes[k] for k in full)
        open_w = sum(x for k, x in enumerate(w) if k not in full)
        over = {k for k in range(len(sizes)) if k not in full and left * w[k] / open_w > most * sizes[k] + 1e-9}
        if not over:
            return [most * s if k in full else left * w[k] / open_w for k, s in enumerate(sizes)]
        full |= over


def corpus(spark):
    texts = [(k, " ".join(["w"] * (k * 37 % 211)), "sé"[k % 2] + str(k * k % 5) if k % 11 else None) for k in range(900)]
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in texts], "doc_id long, text string, lang string, source string, n_chars long")


def test_targets_and_taken_words(spark):
    df = corpus(spark)
    got = mixing.taken(df, block_words=300).join(df.select("doc_id", "source", "text"), "doc_id").collect()
    by = {}
    for r in got:
        assert r["size"] == len(WORD.findall(r["text"])) and 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    order = sorted((s for s in by if s is not None)) + [None]
    want = targets([sum(r["size"] for r in by[s]) for s in order])
    for s, t in zip(order, want, strict=True):
        assert all(r["target"] == pytest.approx(t) for r in by[s])
        assert sum(r["taken"] for r in by[s]) == math.floor(t + 0.5)


@pytest.mark.parametrize("ranges,levels", [(1024, 6), (4, 1)])
def test_shards_of_the_query_are_those_of_the_tree(spark, monkeypatch, ranges, levels):
    monkeypatch.setattr(mixing, "RANGES", ranges)
    monkeypatch.setattr(mixing, "LEVELS", levels)
    df = corpus(spark)
    trees, tree = [], mixing.splitting_tree

    def seen(*args):
        trees.append(tree(*args))
        return trees[-1]

    monkeypatch.setattr(mixing, "splitting_tree", seen)
    got = mixing.taken(df, block_words=300, shards=7).join(df.select("doc_id", "source"), "doc_id").collect()
    quota = {(r["place"], r["shard"]): r["n"] for r in trees[0].collect()}
    order = sorted({r["source"] for r in got if r["source"] is not None}) + [None]
    words, shards = Counter(), set()
    for r in got:
        assert sum(p["words"] for p in r["pieces"]) == r["taken"] and [p["epoch"] for p in r["pieces"]] == list(range(len(r["pieces"])))[-len(r["pieces"]) :] or len(r["pieces"]) == 1
        for p in r["pieces"]:
            words[order.index(r["source"]), p["shard"]] += p["words"]
            shards.add(p["shard"])
    assert shards == set(range(7)) and sum(quota.values()) > 50
    for key, n in quota.items():  # so many blocks of about 300 words, the last of an epoch cut
        assert (words[key] > 0) == (n > 0) and words[key] <= n * 700
    per_shard = Counter()
    for (_, shard), n in quota.items():
        per_shard[shard] += n
    assert max(per_shard.values()) - min(per_shard.values()) <= 3
    positions = [p["position"] for r in got for p in r["pieces"]]
    assert len(set(positions)) == len(positions)


def test_running_sum(spark):
    rows = [(k % 3, k % 7, k, k * k % 11) for k in range(200)]
    df = materialize(spark.createDataFrame(rows, "g int, part int, k int, v long"), "rows")
    got = {r["k"]: r["before"] for r in mixing.running_sum(df, ["g"], "part", ["k"], "v", "before").collect()}
    for g, p, k, _ in rows:
        assert got[k] == sum(v for h, q, j, v in rows if h == g and (q, j) < (p, k))


def test_a_shard_is_a_partition(spark):
    df = corpus(spark)
    rows = materialize(mixing.sized(df), "sized")
    pieces, _ = mixing.mix(rows, block_words=300, shards=5)
    want = {r["shard"]: r["n"] for r in pieces.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    out = mixing.mixed(df, block_words=300, shards=5).withColumn("part", F.spark_partition_id())
    assert {r["part"]: r["count"] for r in out.groupBy("part").count().collect()} == want


def test_reruns_agree_on_other_partitions(spark):
    df = corpus(spark)
    a, b = (sorted(map(tuple, mixing.taken(d, block_words=300).select("doc_id", "taken").collect())) for d in (df, df.repartition(5)))
    assert a == b


def test_hypergeometric_draws_have_the_distribution(spark):
    n = 20_000
    df = spark.range(n).select(mixing._hypergeometric(F.xxhash64("id"), F.lit(20.0), F.lit(8.0), F.lit(10.0)).alias("k"))
    seen = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    chi2 = sum((seen.get(k, 0) - n * p) ** 2 / (n * p) for k in range(9) if (p := math.comb(8, k) * math.comb(12, 10 - k) / math.comb(20, 10)) * n > 5)
    assert chi2 < 30  # 8 degrees of freedom; 0.02 % lie above


def test_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([(0, 1000), (1, 3), (2, 77), (3, 0)], "place long, n long")
    got = mixing.splitting_tree(quotas, 13, 5).collect()
    per_source, per_shard = Counter(), Counter()
    for r in got:
        assert r["n"] >= 0
        per_source[r["place"]] += r["n"]
        per_shard[r["shard"]] += r["n"]
    assert per_source == {0: 1000, 1: 3, 2: 77, 3: 0} and len(per_shard) == 13 and max(per_shard.values()) - min(per_shard.values()) <= 4
    for p in range(4):  # ranges of a source are disjoint and without gaps
        at = 0
        for r in sorted((r for r in got if r["place"] == p), key=lambda r: r["shard"]):
            assert r["first"] == at
            at += r["n"]


def test_pieces_are_disjoint_within_an_epoch(spark):
    rows = materialize(mixing.sized(corpus(spark)), "sized")
    pieces, _ = mixing.mix(rows, block_words=300, shards=5)
    assert pieces.groupBy("row", "epoch").count().filter("count > 1").isEmpty()
    assert {r["shard"] for r in pieces.select("shard").distinct().collect()} == set(range(5))


def test_awkward_rows(spark):
    df = awkward(spark)
    got = mixing.taken(df).collect()
    assert len(got) == df.count()
    out = mixing.mixed(df)
    assert out.columns == df.columns
    words = Counter()
    for r in out.collect():
        words[r["source"]] += len(WORD.findall(r["text"]))
        assert r["text"] is not None and (r["n_chars"] is None or r["n_chars"] == len(r["text"]))
    due = {}
    for s, t in {(r["source"], r["target"]) for r in mixing.source_targets(df.select("source", mixing.F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD)).alias("size"))).collect()}:
        due[s] = math.floor(t + 0.5)
    assert {s: n for s, n in due.items() if n} == dict(words)


def test_empty_table(spark):
    df = documents(spark, [])
    assert mixing.taken(df).count() == 0 and mixing.mixed(df).count() == 0


def test_equal_rows_keep_their_number(spark):
    df = documents(spark, [(k // 3, f"text {k // 3} of a few words") for k in range(90)])
    for share, n in ((1.0, 90), (2.0, 180)):
        out = mixing.mixed(df, share=share, block_words=40)
        assert out.count() == n and {r["count"] for r in out.groupBy("doc_id").count().collect()} == {n // 30}
    words = sum(len(WORD.findall(r["text"])) for r in mixing.mixed(df, share=0.5, block_words=40).collect())
    assert words == 270
