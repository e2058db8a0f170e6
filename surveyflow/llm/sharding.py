"""Sharding by fixed virtual slots.

Records are hashed once and for all into thousands of virtual slots. Bytes and rows are summed per
slot, and a small versioned table says which shard owns which slot. Rebalancing, adding or removing
a shard edits that table only: rows move with their slot, nothing is hashed again.

Edge cases: a null text has no bytes (size 1, CRC of the empty string); rows with a null key are
spread by their text; repeated rows share a slot and get places of their own; an empty table gives
an empty result. Only key and text are read, so further columns cannot clash.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyflow.llm.common import texts

SLOTS = 4096


def into_slots(df: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """One row per record: doc_id, size (UTF-8 bytes plus 1), text_crc32 and virtual_slot."""
    body = F.coalesce("text", F.lit(""))
    return texts(df, key, text).select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), body)), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_loads(rows: DataFrame) -> DataFrame:
    """Bytes and rows of each virtual slot in use: at most as many rows as there are slots."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def even_map(slots: int, shards: int) -> list[int]:
    """The first version: slots dealt round."""
    return [slot % shards for slot in range(slots)]


def rebalanced(owners: list[int], loads: dict[int, int], shards: int) -> list[int]:
    """The next version of a map: as few edits as level the loads of shards 0 to ``shards`` - 1.

    Slots of shards that are gone go to the lightest shard, heaviest first. Then the heaviest shard
    hands the lightest one the slot whose load is nearest to half their gap, until no move of
    theirs brings the two closer.
    """
    owners = list(owners)
    total = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    gone = []
    for slot, owner in enumerate(owners):
        load = loads.get(slot, 0)
        if owner < shards:
            total[owner] += load
            bisect.insort(held[owner], (load, slot))
        else:
            gone.append((load, slot))

    def give(load: int, slot: int, shard: int) -> None:
        total[shard] += load
        bisect.insort(held[shard], (load, slot))
        owners[slot] = shard

    for load, slot in sorted(gone, reverse=True):
        give(load, slot, min(range(shards), key=total.__getitem__))
    while True:
        heavy, light = max(range(shards), key=total.__getitem__), min(range(shards), key=total.__getitem__)
        gap = total[heavy] - total[light]
        at = bisect.bisect_left(held[heavy], (gap / 2, -1))
        near = [p for p in (at - 1, at) if 0 <= p < len(held[heavy]) and 0 < held[heavy][p][0] < gap]
        if not near:
            return owners
        load, slot = held[heavy].pop(min(near, key=lambda p: abs(held[heavy][p][0] - gap / 2)))
        total[heavy] -= load
        give(load, slot, light)


def save_map(spark: SparkSession, folder: str, version: int, owners: list[int]) -> None:
    """Add a version of the slot-to-shard map to the table in ``folder``; earlier ones stay."""
    rows = [(slot, shard) for slot, shard in enumerate(owners)]
    spark.createDataFrame(rows, "virtual_slot int, shard int").coalesce(1).write.parquet(f"{folder}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A version of the map (the newest unless told): virtual_slot, shard, version."""
    maps = spark.read.parquet(folder).select("virtual_slot", "shard", F.col("version").cast("int").alias("version"))
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version)


def place(rows: DataFrame, slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    """``rows`` with their shard, the map's version, and ``slot``: a place in the shard, gapless from 0.

    A place is the number of rows in the shard's earlier virtual slots plus the rank within the own
    one, so no task ever holds a shard. Map and loads have a row per virtual slot and are broadcast.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        slot_map.join(loads, "virtual_slot", "left")
        .withColumn("start", F.coalesce(F.sum(F.coalesce("rows", F.lit(0))).over(before), F.lit(0)))
        .select("virtual_slot", "shard", "version", "start")
    )
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        rows.withColumn("rank", rank)
        .join(F.broadcast(starts), "virtual_slot")
        .select(
            "doc_id", "size", "text_crc32", "virtual_slot", "shard", "version",
            (F.col("start") + F.col("rank") - 1).cast("long").alias("slot"),
        )
    )
