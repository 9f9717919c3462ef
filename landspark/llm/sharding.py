"""Sharding by fixed virtual slots.

Every record is hashed into one of a fixed number of virtual slots. Bytes and rows are
aggregated per slot; only that table, of at most ``slots`` rows, reaches the driver. A
slot-to-shard map is stored by version and edited when shards are rebalanced or added,
so only records of moved slots move.

Null ids and texts hash like any other value; a null text has no bytes. Equal records
share a virtual slot, and are counted before anything is put in order, so a record that is
repeated very often is no large group. Empty tables give empty shards. Only id and text are
read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landspark.llm.common import materialize

#: Equal records that are written out at once.
RUN = 100_000
#: Bytes counted for each record besides its text.
RECORD_BYTES = 8


def virtual_slot(slots: int, *cols: Column) -> Column:
    """The record's fixed virtual slot."""
    return F.pmod(F.xxhash64(*cols), F.lit(slots)).cast("int")


def sized(docs: DataFrame, slots: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` of each record."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return rows.withColumn("virtual_slot", virtual_slot(slots, F.col("doc_id"), F.col("text_crc32")))


def slot_stats(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each virtual slot; at most one entry per slot."""
    found = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return {r["virtual_slot"]: (r["bytes"], r["rows"]) for r in found.collect()}


def first_map(slots: int, shards: int) -> list[int]:
    """Version 1 of a map: slots dealt out in turn."""
    return [s % shards for s in range(slots)]


def rebalanced(old: list[int], shards: int, bytes_of: dict[int, int]) -> list[int]:
    """An edited map whose shards have nearly equal bytes.

    Slots are taken from the largest down. A slot stays where it is while its shard
    remains within the mean, else it goes to the emptiest shard, so the shards differ by
    little more than one small slot. Empty slots stay, unless their shard is gone.
    """
    mean = sum(bytes_of.values()) / shards
    load = [0] * shards
    heap = [(0, k) for k in range(shards)]
    new = [s if s < shards else k % shards for k, s in enumerate(old)]
    for slot in sorted(bytes_of, key=lambda s: (-bytes_of[s], s)):
        to, size = old[slot], bytes_of[slot]
        if to >= shards or load[to] + size > mean:
            while heap[0][0] != load[heap[0][1]]:  # an outdated entry
                heapq.heappop(heap)
            to = heap[0][1]
        load[to] += size
        heapq.heappush(heap, (load[to], to))
        new[slot] = to
    return new


class SlotMap:
    """Versions of a slot-to-shard map, stored as Parquet: ``version, virtual_slot, shard``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def save(self, version: int, shards: list[int]) -> None:
        """Stores one version; saving it again replaces it."""
        rows = self.spark.createDataFrame(list(enumerate(shards)), "virtual_slot int, shard int").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}/version={version}")

    def load(self, version: int) -> DataFrame:
        """``virtual_slot, shard`` of a version."""
        return self.spark.read.schema("virtual_slot int, shard int").parquet(f"{self.path}/version={version}")


def shard(docs: DataFrame, shards: int, slot_map: SlotMap, slots: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deals all records to shards of nearly equal bytes.

    Stores map versions 1 (dealt in turn) and 2 (edited by bytes) and returns ``doc_id,
    size, text_crc32, virtual_slot, shard, slot``; ``slot`` numbers a shard's records
    from 0 without gaps. Equal records are one row with their number while they are put in
    order within their virtual slot, behind the shard's smaller virtual slots, so no task
    holds more than one virtual slot's distinct records.
    """
    rows = materialize(sized(docs, slots, id_col, text_col), "sized")
    stats = slot_stats(rows)
    slot_map.save(1, old := first_map(slots, shards))
    slot_map.save(2, new := rebalanced(old, shards, {s: b for s, (b, _) in stats.items()}))
    before, offsets = [0] * shards, []
    for s in range(slots):
        offsets.append((s, before[new[s]]))
        before[new[s]] += stats.get(s, (0, 0))[1]
    starts = docs.sparkSession.createDataFrame(offsets, "virtual_slot int, first_slot long")
    place = slot_map.load(2).join(F.broadcast(starts), "virtual_slot")  # one row per virtual slot
    # equal records are interchangeable: their number says what places they take
    record = ["virtual_slot", "doc_id", "text_crc32", "size"]
    counted = rows.groupBy(*record).agg(F.count("*").alias("n"))
    order = W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size").rowsBetween(W.unboundedPreceding, -1)
    numbered = counted.withColumn("nth", F.coalesce(F.sum("n").over(order), F.lit(0)))
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long")))
    each = numbered.withColumn("run", runs).withColumn("k", F.explode(F.sequence(F.col("run"), F.least(F.col("run") + RUN, F.col("n")) - 1)))
    return each.join(F.broadcast(place), "virtual_slot").select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("first_slot") + F.col("nth") + F.col("k")).alias("slot"))
