"""Exact deduplication against a persistent digest index (native).

The index is a table bucketed and sorted by digest, one row for each distinct text
seen so far; it is made empty before the first batch. A batch is reduced to one row per
digest before anything is shuffled by digest, anti-joined with the index by a sort-merge
join that reads the index in its stored order, and the new digests are appended. Texts
themselves are never shuffled.

A table may be dealt into batches by id, so that the first id of a text is met first.
Null texts count as empty. Rows with the same id and text are repeats: the first one
stays. A null id is larger than any other and comes in the last batch. An empty batch adds
nothing. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from landspark.llm.common import SPACE, materialize
from landspark.sources import stored


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_sha256, row``: the SHA-256 of the text with white space made single.

    ``row`` numbers the rows; it is stable once the result is written.
    """
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ")
    return docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("text_sha256")).withColumn("row", F.monotonically_increasing_id())


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays and the number of rows."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    return (
        rows.groupBy("text_sha256")
        .agg(first.alias("first"), F.count("*").alias("group_size"))
        .select("text_sha256", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")
    )


def buckets_for(rows: int) -> int:
    """Buckets of an index that is to hold so many digests: some two million each, and 64 at least."""
    return max(64, -(-rows // 2_000_000))


class DigestIndex:
    """A persistent table ``text_sha256, keep_id, batch`` at a path, bucketed and sorted by digest.

    The path is in a folder that all executors and later sessions share; any session opens the index by it. The
    number of buckets is fixed when the table is made (see :func:`buckets_for`); a task of a join reads one bucket.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        if stored.is_stored(spark, path):
            stored.read_stored(spark, path, refresh=True)  # another session may have added to it

    def read(self) -> DataFrame:
        """All digests seen so far."""
        return stored.read_stored(self.spark, self.path)

    def create(self, id_type: str) -> None:
        """Makes the empty table unless it is there."""
        stored.create_stored(self.spark, self.path, f"text_sha256 string, keep_id {id_type}, batch string", ["text_sha256"], self.buckets)

    def drop(self) -> None:
        """Deletes the table; for an index that only one job needs."""
        stored.drop_stored(self.spark, self.path)

    def unseen(self, found: DataFrame) -> DataFrame:
        """Those rows of ``found`` whose digest the index lacks."""
        return found.join(self.read().select("text_sha256").hint("merge"), "text_sha256", "left_anti")

    def append(self, found: DataFrame, batch: str) -> None:
        """Adds those digests of ``found`` (from :func:`groups`) that the index lacks.

        Running it again with the same batch adds nothing, so a job may be repeated.
        """
        self.create(found.schema["keep_id"].dataType.simpleString())
        new = self.unseen(found).select("text_sha256", "keep_id", F.lit(batch).alias("batch"))
        stored.append_stored(new, self.path)  # one task, and one file, per bucket and batch


def _bounds(rows: DataFrame, batches: int) -> list | None:
    """The ids at which batches end: quantiles of numbers, or of a sample of 1,000 other ids."""
    shares = [k / batches for k in range(1, batches)]
    if isinstance(rows.schema["doc_id"].dataType, NumericType):
        return rows.agg(F.percentile_approx("doc_id", shares)).first()[0]
    some = sorted(r["doc_id"] for r in rows.filter("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id")).limit(1000).select("doc_id").collect())
    return [some[int(len(some) * x)] for x in shares] if some else None


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text", batches: int = 1) -> DataFrame:
    """Appends a table to the index and returns the decision on each of its rows.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``. A row is kept if the
    index had no such text before and it is the first of its group by id. ``group_size``
    counts the rows of this table. With ``batches`` the table is dealt by ranges of its ids
    into that many batches, each of which meets the digests of those before.
    Appending the same ``batch`` again changes no decision. The hot groups of the last
    join are split by adaptive execution; both its sides are plain shuffles of short rows.
    """
    rows = materialize(digests(docs, id_col, text_col), "digests")
    bounds = _bounds(rows, batches) if batches > 1 else None
    part = F.lit(batches - 1) if not bounds else F.coalesce(sum((F.col("doc_id") > b).cast("int") for b in sorted(set(bounds))), F.lit(batches - 1))
    first_rows = []
    for k in range(batches):
        found = materialize(groups(rows if batches == 1 else rows.filter(part == k)), "groups")
        index.append(found, f"{batch}/{k}")
        first_rows.append(found.select("text_sha256", "keep_row", "group_size", F.lit(f"{batch}/{k}").alias("batch")))
    # a digest's first row is in the batch that brought it to the index
    known = index.read().select("text_sha256", F.col("keep_id").alias("index_id"), F.col("batch").alias("brought_by")).hint("merge")
    sizes = reduce(DataFrame.union, first_rows).groupBy("text_sha256").agg(F.sum("group_size").alias("group_size"), F.collect_list(F.struct("batch", "keep_row")).alias("firsts"))
    brought = F.filter("firsts", lambda x: x["batch"] == F.col("brought_by"))
    decided = sizes.join(known, "text_sha256").select("text_sha256", F.col("index_id").alias("keep_id"), "group_size", F.get(brought, F.lit(0))["keep_row"].alias("keep_row"))
    decided = materialize(decided, "decided")
    return rows.join(decided.hint("merge"), "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"), "text_sha256"
    )
