"""Semantics that are easily got wrong, each on a hand-made frame."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landspark.functions.row_ids import numbered
from landspark.operators import features, insitu, metrics, objects, post, samples, split
from landspark.operators import grid as gr
from tests.conftest import rows

NAN = float("nan")


def test_nulls_survive_unequal_filters(spark):
    df = spark.createDataFrame([("1", "1"), ("2", "0"), ("3", None), (None, "1"), ("9999", "1"), ("0", "1")], "crop string, mixed string")
    crop, noncrop = insitu.split_crop_noncrop(df)
    assert crop.count() == 5 and rows(noncrop.select("crop")) == [("9999",)]
    got = rows(insitu.recode_mixed(df))
    # a row marked as mixed is recoded even if its code is missing; an unknown mixed crop and mixed non-crop go
    assert got == [("2", "0"), ("2132", "1"), ("2132", "1"), ("3", None)]
    codes = spark.createDataFrame([(1,), (2136,), (None,)], "map_code int")
    assert rows(insitu.exclude_classes(codes, [2136])) == [(None,), (1,)]


def test_index_on_nodata_cells(spark):
    df = spark.createDataFrame([(0, 0, 0.0, 0.0, 0.0, 0.0), (0, 1, 0.0, 5.0, 9.0, 0.0), (0, 2, 10.0, 4.0, 1.0, 30.0)], "row_id int, col_id int, red float, green float, blue float, nir float")
    got = {r["col_id"]: r for r in features.build_feature_cube(df).collect()}
    assert got[0]["red"] == -9999 and got[0]["ndvi"] == 0 and got[0]["ndwi"] == 0
    assert got[1]["ndvi"] == -9999 and got[1]["ndwi"] == 1
    assert got[2]["ndvi"] == np.float32(0.5)


def test_float_parity_with_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.random(500, "f4") * 100, rng.random(500, "f4") * 100
    df = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(zip(a, b, strict=True))], "k int, a float, b float")
    got = [r["o"] for r in features.normalized_difference(df, "a", "b", "o").orderBy("k").collect()]
    assert np.array_equal(np.array(got, "f4"), ((a - b).astype("f8") / (a + b)).astype("f4"))


def test_standardize_uses_cells_valid_in_all_bands(spark):
    values = [(0, k, float(k), float(k), 1.0, float(k), 0.1, 0.2) for k in range(4)] + [(0, 9, 50.0, 50.0, 50.0, 50.0, -9999.0, 0.2)]
    df = spark.createDataFrame(values, "row_id int, col_id int, red float, green float, blue float, nir float, ndvi float, ndwi float")
    got = {r["col_id"]: r for r in features.standardize(df).collect()}
    assert got[9]["red"] == -9999 and got[9]["ndwi"] == np.float32(0.2) and got[9]["ndvi"] == -9999
    assert got[0]["red"] == pytest.approx((0 - 1.5) / math.sqrt(1.25)) and got[0]["blue"] is None  # no spread


def test_zonal_stats(spark):
    cells = spark.createDataFrame([(0, 0, 1, 2.0), (0, 1, 1, 4.0), (0, 2, 1, -9999.0), (0, 3, 2, NAN), (0, 4, 2, 3.0), (0, 5, 0, 7.0)], "row_id int, col_id int, seg_id long, red float")
    got = {r["seg_id"]: r for r in objects.zonal_stats(cells, bands=("red",)).collect()}
    assert got[1]["red_min"] == -9999 and got[1]["n"] == 3 and 0 not in got
    assert all(math.isnan(got[2][f"red_{s}"]) for s in ("mean", "min", "max"))
    got = {r["seg_id"]: r for r in objects.zonal_stats(cells, bands=("red",), exclude_nodata=True).collect()}
    assert got[1]["red_mean"] == 3 and got[1]["red_std"] == 1 and got[1]["red_min"] == 2
    matrix = objects.object_matrix(objects.zonal_stats(cells, bands=("red",)), ("red",))
    assert matrix.columns == ["seg_id", "red_mean", "red_std", "red_min", "red_max"]


def test_majority_tie_and_purity(spark):
    counts = spark.createDataFrame([(1, 20, 5), (1, 10, 5), (2, 7, 9), (2, 8, 1), (3, -1, 4)], "seg_id long, label int, n long")
    assert rows(objects.majority_label(counts, 0.5).select("seg_id", "label")) == [(1, 10), (2, 7)]
    assert rows(objects.majority_label(counts).select("seg_id", "label")) == [(2, 7)]


def test_greedy_split_is_not_a_prefix_sum(spark):
    polys = spark.createDataFrame([(k, 1, n) for k, n in enumerate([10, 80, 5, 5, None, 1], 1)] + [(99, None, 3)], "poly_id long, crop_code int, pix_count long")
    got = {r["poly_id"]: r["set"] for r in split.greedy_split(polys).collect()}
    order = sorted(range(1, 7), key=lambda k: ((k * 2654435761 + 42) % 2147483647, k))
    size, so_far, want = {1: 10, 2: 80, 3: 5, 4: 5, 5: None, 6: 1}, 0, {99: "val"}
    for k in order:
        fits = size[k] is not None and so_far + size[k] <= 101 * 0.75
        so_far += size[k] if fits else 0
        want[k] = "cal" if fits else "val"
    assert got == want and want[2] == "val" and so_far == 21


def test_greedy_split_does_not_depend_on_partitions(spark):
    polys = spark.range(500).select(F.col("id").alias("poly_id"), (F.col("id") % 3).cast("int").alias("crop_code"), (F.col("id") % 17 + 1).alias("pix_count"))
    found = [rows(split.greedy_split(polys.repartition(n))) for n in (1, 7)]
    assert found[0] == found[1] and len(found[0]) == 500
    for code in range(3):
        own = [r for r in found[0] if r[1] == code]
        assert sum(r[2] for r in own if r[3] == "cal") <= 0.75 * sum(r[2] for r in own)


def test_clean_code(spark):
    df = spark.createDataFrame([("1111\n",), ("1111x",), ("12.0",), (None,), ("",), (" 7 ",)], "crop string")
    assert [r["crop_code"] for r in insitu.clean_code(df).collect()] == [1111, None, 12, None, None, 7]


def test_report_has_the_union_of_labels(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (3, 3), (None, 1)], "y_true int, y_pred int")
    got = {r["name"]: r for r in metrics.classification_report(df).collect()}
    assert set(got) == {"1", "2", "3", "accuracy", "macro avg", "weighted avg"}
    assert got["2"]["recall"] == 0 and got["2"]["support"] == 0
    assert {got["accuracy"][c] for c in ("precision", "recall", "f1", "support")} == {2 / 3}
    assert metrics.balanced_accuracy(df).first()[0] == 0.75
    wide = metrics.confusion_matrix_wide(df)
    assert wide.columns == ["y_true", "p_1", "p_2", "p_3"] and rows(wide)[0] == (1, 1, 1, 0)
    assert rows(metrics.missing_predictions(df)) == []


def test_metrics_of_nothing(spark):
    df = spark.createDataFrame([], "y_true int, y_pred int")
    assert metrics.accuracy(df).first()[0] is None and metrics.cohen_kappa(df).first()[0] is None
    assert metrics.confusion_matrix(df).count() == 0


def test_index_rules(spark):
    cells = spark.createDataFrame([(0, k, c) for k, c in enumerate([6999, 6999, 6999, -9999, 6999, 6999])], "row_id int, col_id int, class_code int")
    index = spark.createDataFrame([(0, 0, 0.48, 0.0), (0, 1, 0.2, 0.5), (0, 2, 0.9, 0.11), (0, 3, 0.1, 0.9), (0, 4, NAN, NAN)], "row_id int, col_id int, ndvi float, ndwi float")
    assert rows(post.apply_index_rules(cells, index)) == [(0, 0, 8111), (0, 1, 9111), (0, 2, 6999), (0, 3, -9999), (0, 4, 6999), (0, 5, 6999)]
    assert post.rule_counts(cells, index).first().asDict() == {"low_ndvi": 3, "high_ndwi": 2}


def test_legend_and_crosswalk(spark):
    df = spark.createDataFrame([(0,), (1,), (9999,), (9311,), (4242,), (None,)], "crop_code int")
    got = {r["crop_code"]: (r["crop_label"], r["map_code"]) for r in insitu.crosswalk(insitu.apply_legend(df)).collect()}
    assert got == {0: ("Other crops", 1192), 1: ("Sand", 8511), 9999: ("Noncrop", None), 9311: ("Clouds", 9311), 4242: ("4242", None), None: (None, None)}


def test_incomplete_rows_of_stacked_sources(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, a string"), spark.createDataFrame([(2, "y")], "id int, b string")
    both = insitu.concat_sources(a, b)
    assert insitu.drop_incomplete(both).count() == 0 and insitu.drop_incomplete(both, ["id", "a"]).count() == 1


def test_unseen_classes(spark):
    val, train = (spark.createDataFrame([(x,) for x in xs], "label int") for xs in ([1, 2, 2, 5], [1, 2]))
    kept, gone = metrics.drop_unseen_classes(val, train)
    assert kept.count() == 3 and rows(gone) == [(5, 1)]


def test_samples_keep_nodata_features(spark):
    cells = spark.createDataFrame([(0, 0, NAN), (0, 1, -9999.0), (0, 2, 1.0)], "row_id int, col_id int, red float")
    labels = spark.createDataFrame([(0, 0, 5), (0, 1, 5), (0, 2, -9999)], "row_id int, col_id int, label int")
    assert rows(samples.extract_samples(cells, labels, ("red",))) == [(0, 0, -9999.0, 5), (0, 1, -9999.0, 5)]


def test_empty_validation_set(spark):
    polys = spark.createDataFrame([(1,)], "poly_id long")
    cells = spark.createDataFrame([(0, 0, 1)], "row_id int, col_id int, poly_id long")
    with pytest.raises(ValueError, match="no polygon"):
        split.split_overlap(polys, polys.limit(0), cells)


@pytest.mark.parametrize("parts", [1, 7])
def test_numbered(spark, parts):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(parts)
    assert all(r["k"] + 1 == r["n"] for r in numbered(df, ["k"], "n").collect())


def test_alignment():
    with pytest.raises(ValueError, match="size"):
        gr.check_alignment(gr.Grid(width=1, height=1), gr.Grid(width=2, height=1))
    with pytest.raises(ValueError, match="reference system"):
        gr.check_alignment(gr.Grid(crs="a"), gr.Grid(crs="b"))
    with pytest.warns(UserWarning, match="origin"):
        gr.check_alignment(gr.Grid(), gr.Grid(x0=1))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    from types import SimpleNamespace

    from landspark.sources.shared import shared_dir

    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(spark)


def test_rows_that_can_fit_nowhere_are_for_validation(spark):
    polys = spark.createDataFrame([(1, 10, 5), (2, 10, None), (3, None, 5), (4, 10, 100), (5, None, None)], "poly_id long, crop_code int, pix_count long")
    got = {r["poly_id"]: r["set"] for r in split.greedy_split(polys, pct=50).collect()}
    assert got == {1: "cal", 2: "val", 3: "val", 4: "val", 5: "val"}
