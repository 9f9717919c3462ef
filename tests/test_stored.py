"""Tables in buckets: joins without an exchange, and opening them again."""

import pytest
from pyspark.sql import functions as F

from landspark.operators import grid, objects, post, samples
from landspark.sources import stored
from landspark.sources.shared import new_path
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def apart(spark):
    """No broadcasts, so that joins show what they move."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def cells(spark):
    base = spark.range(400).selectExpr("CAST(id % 20 AS INT) AS row_id", "CAST(floor(id / 20) AS INT) AS col_id", "id")
    bands = base.select("row_id", "col_id", *[(F.col("id") % k).cast("float").alias(b) for k, b in enumerate(("red", "green", "blue", "nir"), 3)], *[((F.col("id") % k) / 10 - 0.3).cast("float").alias(b) for k, b in ((7, "ndvi"), (9, "ndwi"))])
    labels = base.filter("id % 3 = 0").selectExpr("row_id", "col_id", "CAST(id % 4 AS INT) AS label")
    segments = base.selectExpr("row_id", "col_id", "id % 11 AS seg_id")
    classes = base.selectExpr("row_id", "col_id", "CASE WHEN id % 5 = 0 THEN -9999 ELSE 2417 END AS class_code")
    return {"bands": bands, "labels": labels, "segments": segments, "classes": classes}


def test_cells_stored_alike_are_joined_in_place(spark, apart):
    loose, kept = cells(spark), {}
    for name, df in loose.items():
        path = new_path(spark, name)
        stored.write_stored(df, path, ["row_id", "col_id"], 8)
        kept[name] = stored.read_stored(spark, path)
    for own in (lambda t: samples.extract_samples(t["bands"], t["labels"]), lambda t: post.apply_index_rules(t["classes"], t["bands"])):
        got = own(kept)
        assert "Exchange" not in plan(got) and "Exchange" in plan(own(loose))
        assert rows(got) == rows(own(loose))
    got = objects.zonal_stats(kept["bands"], kept["segments"])
    assert plan(got).count("Exchange hashpartitioning(seg_id") == plan(got).count("Exchange ") == 1  # that of the groups
    assert rows(got.select("seg_id", "n", "red_min")) == rows(objects.zonal_stats(loose["bands"], loose["segments"]).select("seg_id", "n", "red_min"))


def test_another_catalog_opens_the_table(spark):
    path, df = new_path(spark, "table"), spark.range(50).selectExpr("id", "concat('t', id % 7) AS name")
    stored.write_stored(df.limit(20), path, ["name"], 3)
    spark.sql(f"DROP TABLE {stored._registered(spark, path)}")  # as a session that never saw it: files and layout are all there is
    stored.append_stored(df.filter("id >= 40"), path)
    assert stored.is_stored(spark, path) and stored.read_stored(spark, path).count() == 30
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {stored._registered(spark, path)}").collect()}
    assert described["Num Buckets"] == "3" and described["Sort Columns"] == "[`name`]" and described["Type"] == "EXTERNAL"
    with pytest.raises(ValueError):
        stored.write_stored(df, path, ["name"], 3)
    stored.drop_stored(spark, path)
    assert not stored.is_stored(spark, path)
    stored.create_stored(spark, path, "id long, name string", ["name"], 2)
    assert stored.read_stored(spark, path).count() == 0


def test_bands_are_stacked_in_one_pass(spark, apart):
    t = cells(spark)
    few = t["labels"].filter("row_id < 5")
    got = grid.stack_bands(t["segments"], few, t["classes"].filter("col_id > 3"))
    assert plan(got).count("Exchange ") == 1 and "Join" not in plan(got)
    want = t["segments"].join(few, ["row_id", "col_id"], "full").join(t["classes"].filter("col_id > 3"), ["row_id", "col_id"], "full")
    assert rows(got) == rows(want)
    with pytest.raises(ValueError):
        grid.stack_bands(few, few)


def test_an_append_writes_one_file_a_bucket(spark):
    path = new_path(spark, "files")
    for at in (0, 1000):
        stored.append_stored(spark.range(at, at + 1000).selectExpr("cast(id AS string) AS k", "id"), path) if at else stored.write_stored(spark.range(1000).selectExpr("cast(id AS string) AS k", "id"), path, ["k"], 8)
    got = stored.read_stored(spark, path)
    assert len(got.inputFiles()) == 16 and got.count() == 2000
    # a file's rows are of the bucket that it is named for
    named = got.select(F.regexp_extract(F.input_file_name(), "_(\\d+)\\.c", 1).cast("int").alias("named"), F.expr("pmod(hash(k), 8)").alias("bucket"))
    assert named.filter("named != bucket OR named IS NULL").count() == 0
