"""Shards by fixed virtual slots and a versioned slot map.

Every record hashes into one of ``SLOTS`` virtual slots for good. Bytes and rows are
summed per slot, and a small table says which shard owns a slot. Rebalancing and
growing only edit that table, as a new version, so few records move.

Null or empty text counts no bytes; a null id hashes like any other value. Rows that
are equal in every way share a virtual slot and get neighbouring places. An empty
table gives an empty result. A long text counts its bytes like any other; other columns
can have any name. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_dir
from .common import picked

SLOTS = 8192
OVERHEAD = 16


def records(docs: DataFrame, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of every row."""
    rows = picked(docs, doc_id, text)
    content = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    return rows.select(
        "doc_id",
        (F.octet_length(content).cast("bigint") + OVERHEAD).alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_loads(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """virtual_slot, bytes, rows for every slot, empty ones with zeros."""
    loads = rows.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(loads, "virtual_slot", "left").na.fill(0, ["bytes", "rows"])


def first_map(loads: DataFrame, shards: int) -> DataFrame:
    """Version 0: slots dealt in turn, whatever they hold."""
    return loads.withColumn("shard", F.pmod("virtual_slot", F.lit(shards)).cast("int"))


def _filled(slot_map: DataFrame, shards: int) -> DataFrame:
    """The map and whether a shard keeps a slot: its largest first, up to an even share.

    Both windows are over the map's ``SLOTS`` rows.
    """
    largest = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    total = F.sum("bytes").over(Window.partitionBy(F.lit(0)))
    return slot_map.select(
        "virtual_slot", "bytes", "rows", "shard", (F.sum("bytes").over(largest) <= total / shards).alias("stays")
    )


def rebalanced(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version: slots beyond a shard's even share go, largest first, to the emptiest shard.

    The greedy deal is one row of at most ``SLOTS`` entries, whatever the data's size.
    """
    filled = _filled(slot_map, shards)
    entry = F.struct((-F.col("bytes")).alias("order"), "virtual_slot", "bytes", "rows")
    held = [F.sum(F.when(F.col("stays") & (F.col("shard") == s), F.col("bytes")).otherwise(0)) for s in range(shards)]
    free = filled.agg(
        F.array_sort(F.collect_list(F.when(~F.col("stays"), entry))).alias("free"),
        F.array(*[F.coalesce(x, F.lit(0)) for x in held]).alias("loads"),
    )
    nothing = F.expr("CAST(array() AS array<struct<virtual_slot:int,bytes:bigint,rows:bigint,shard:int>>)")

    def emptiest(loads):
        return (F.array_position(loads, F.array_min(loads)) - 1).cast("int")

    def deal(done, slot):
        to = done["to"]
        loads = F.transform(done["loads"], lambda x, i: x + F.when(i == to, slot["bytes"]).otherwise(0))
        dealt = F.struct(slot["virtual_slot"], slot["bytes"], slot["rows"], to.alias("shard"))
        return F.struct(
            loads.alias("loads"),
            emptiest(loads).alias("to"),
            F.concat(done["dealt"], F.array(dealt)).alias("dealt"),
        )

    start = F.struct("loads", emptiest(F.col("loads")).alias("to"), nothing.alias("dealt"))
    dealt = free.select(F.explode(F.aggregate("free", start, deal)["dealt"]).alias("x"))
    return filled.where("stays").drop("stays").unionByName(dealt.select("x.*"))


def grown(slot_map: DataFrame, shards: int) -> DataFrame:
    """The map for one more shard: slots move only into the new one, numbered ``shards``."""
    filled = _filled(slot_map, shards + 1)
    shard = F.when(F.col("stays"), F.col("shard")).otherwise(F.lit(shards))
    return filled.withColumn("shard", shard).drop("stays")


def save_version(slot_map: DataFrame, folder: str, version: int) -> DataFrame:
    """Write one version of the map below ``folder`` and read it back."""
    path = f"{folder}/version={version}"
    slot_map.write.parquet(path)
    return slot_map.sparkSession.read.schema(slot_map.schema).parquet(path)


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, shard and the row's place in its shard, from 0 without gaps.

    Places are counted per virtual slot, after the slots before it in the shard, so no
    task sorts a whole shard. The map has ``SLOTS`` rows and is broadcast.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(starts), "virtual_slot").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).alias("slot")
    )


def shard_documents(
    spark: SparkSession, docs: DataFrame, shards: int = 40, slots: int = SLOTS, folder: str | None = None
) -> DataFrame:
    """Place every row; map versions 0 (dealt in turn) and 1 (balanced by bytes) stay in ``folder``."""
    folder = folder or fresh_dir(spark, "llm-slot-map")
    rows = records(docs, slots)
    dealt = save_version(first_map(slot_loads(rows, slots), shards), folder, 0)
    balanced = save_version(rebalanced(dealt, shards), folder, 1)
    return placed(rows, balanced)
