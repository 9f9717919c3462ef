"""Consecutive numbers in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landspark.sources.shared import materialize


def numbered(df: DataFrame, order: list[str], out: str, first: int = 1) -> DataFrame:
    """``df`` with ``out``: 1, 2, ... in the order of the columns ``order``.

    Rows are range-partitioned by the order and numbered within their partition; the
    partitions' row counts, one row each, give every partition its offset. The rows are
    written with their partition and place in the shared folder, so that counts and numbers
    agree even if a task is run again. The order must end with a unique column.
    """
    # the id of a row has its partition in the upper bits and its place there in the lower 33
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    parts = materialize(dealt, "numbered")
    part, nth = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = parts.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return parts.join(F.broadcast(offsets), part == F.col("_part")).withColumn(out, (nth + F.col("_before") + first).cast("long")).drop("_id", "_part", "_before")
