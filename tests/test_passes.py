"""What is read in many passes is computed once, and large tables are dealt to more tasks."""

from pyspark.sql import functions as F

from landspark.operators import grid, model
from landspark.plans.fixtures import Tables
from landspark.sources.shared import new_path, tasks_for
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_cells_are_dealt_by_the_size_of_their_table(spark):
    path = f"{SF}/lineitem.parquet"
    assert tasks_for(spark, path) == spark.sparkContext.defaultParallelism
    assert tasks_for(spark, path, 1000) > 50
    # adaptive execution would make one partition of so small a table
    assert Tables(spark, SF).cells.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_samples_of_a_fit_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def costly(x):
        seen.add(1)
        return float(x)

    samples = spark.range(40).select(costly(F.col("id") % 2).alias("a"), (F.col("id") % 2 + 7).cast("int").alias("label"))
    trained = model.fit_classifier(samples, ["a"], trees=3, depth=2)
    assert seen.value == 40
    assert {(r["a"], r["class_code"]) for r in trained.predict(spark.createDataFrame([(0.0,), (1.0,)], "a double")).collect()} == {(0.0, 7), (1.0, 8)}


def test_labels_of_polygons_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def costly(x):
        seen.add(1)
        return x

    cells = spark.createDataFrame([(r, c, c // 2 + 1) for r in range(3) for c in range(4)], "row_id int, col_id int, seg_id long")
    labels = spark.createDataFrame([(1, 6), (2, 7)], "seg_id long, label int").withColumn("seg_id", costly("seg_id"))
    for window in (2, 512):
        seen.value = 0
        found = grid.segment_polygons(cells, labels, window=window).select("seg_id", "class_code", "n_cells", F.size("ring"), F.size("holes"))
        assert rows(found) == [(1, 6, 6, 5, 0), (2, 7, 6, 5, 0)] and seen.value == 2


def test_cells_are_predicted_in_one_pass(spark):
    samples = spark.createDataFrame([(float(k % 2), k % 2 + 7) for k in range(40)], "a double, label int")
    trained = model.fit_classifier(samples, ["a"], trees=3, depth=2)
    path = new_path(spark, "cells")
    spark.createDataFrame([(0, 0, 1.0), (0, 1, float("nan")), (0, 2, None), (0, 3, -9999.0), (0, 4, 0.0)], "row_id int, col_id int, a double").write.parquet(path)
    found = model.predict_cells(spark.read.parquet(path), trained)
    assert rows(found) == [(0, 0, 8), (0, 1, -9999), (0, 2, -9999), (0, 3, -9999), (0, 4, 7)]
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()
