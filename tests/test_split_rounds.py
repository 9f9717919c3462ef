"""The greedy split in rounds against a sequential walk."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landspark.operators import split
from tests.conftest import rows


def walk(polygons, pct, seed):
    """The split polygon by polygon."""
    key = lambda i: (i % 2147483647 * 2654435761 + seed) % 2147483647
    total, taken, out = {}, {}, {}
    for _, c, n in polygons:
        total[c] = total.get(c, 0) + (n or 0)
    for i, c, n in sorted(polygons, key=lambda p: (key(p[0]), p[0])):
        fits = c is not None and n is not None and taken.get(c, 0) + n <= total[c] * pct / 100
        taken[c] = taken.get(c, 0) + (n if fits else 0)
        out[i] = "cal" if fits else "val"
    return sorted((i, c, n, out[i]) for i, c, n in polygons)


def some(seed, n=400):
    """Classes of very different sizes, one with single giants, one whose polygons hardly ever fit, and gaps."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        c = [1, 1, 1, 2, 3, 4][int(rng.integers(6))]
        size = {1: int(rng.integers(1, 50)), 2: int(rng.choice([1, 2, 5000])), 3: int(rng.integers(90, 110)), 4: 1}[c]
        out.append((i * 7 + 1, c, size))
    return [*out, (10_001, None, 5), (10_002, 1, None), (10_003, 9, 3), (10_004, 8, None)]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize(("walk_rows", "rounds"), [(0, 3), (40, 40)])
def test_rounds_equal_the_walk(spark, seed, walk_rows, rounds):
    polygons = some(seed)
    df = spark.createDataFrame(polygons, "poly_id long, crop_code int, pix_count long").repartition(7)
    got = split.greedy_split(df, 75, 42, walk_rows=walk_rows, rounds=rounds)
    assert sorted(((r["poly_id"], r["crop_code"], r["pix_count"], r["set"]) for r in got.collect()), key=lambda r: r[0]) == sorted(walk_all(polygons), key=lambda r: r[0])


def walk_all(polygons):
    known = walk([p for p in polygons if p[1] is not None], 75, 42)
    return [*known, *((i, c, n, "val") for i, c, n in polygons if c is None)]


def test_one_large_class_is_many_tasks(spark):
    """A million polygons of one class: all but a few are settled by sums of partitions."""
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        df = spark.range(1_000_000).selectExpr("id AS poly_id", "7 AS crop_code", "1 + id * 7919 % 97 AS pix_count")
        got = split.greedy_split(df, walk_rows=1000)
        most = got.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert most[0] < 400_000 and most[1] >= 4
    cal = got.filter("set = 'cal'").agg(F.sum("pix_count"), F.count("*")).first()
    target = 0.75 * df.agg(F.sum("pix_count")).first()[0]
    assert target - 1 <= cal[0] <= target and got.count() == 1_000_000
    assert rows(got.groupBy("crop_code").count()) == [(7, 1_000_000)]
