"""Sharding by fixed virtual slots: records hash into slots, a versioned map sends slots to shards."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.llm.common import whole_text
from tidebook.session import shared_dir
from tidebook.sinks import files

SLOTS = 4096
SHARDS = 16


def with_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of each row; a null id hashes by its text instead."""
    text = whole_text(F.col("text"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(
            F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.xxhash64(F.col("doc_id").cast("long"))),
            F.lit(slots),
        )
        .cast("int")
        .alias("virtual_slot"),
    )


def slot_bytes(slotted: DataFrame) -> DataFrame:
    """Bytes and rows of each virtual slot that has rows; at most as many rows as there are slots."""
    return slotted.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )


def first_map(sizes: dict[int, int], slots: int = SLOTS, shards: int = SHARDS) -> list[int]:
    """Shard of each slot: large slots first, each to the shard with the fewest bytes so far."""
    load = [(0, 0, shard) for shard in range(shards)]
    heapq.heapify(load)
    placed = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        total, n, shard = heapq.heappop(load)
        placed[slot] = shard
        heapq.heappush(load, (total + sizes.get(slot, 0), n + 1, shard))
    return placed


def edited_map(placed: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """The next version of a map: slots leave the fullest shards for the emptiest until no move helps.

    Serves growth (slots move into new shards only), drift of sizes, and removal (slots of shards at or
    beyond ``shards`` move away).  Every other slot stays where it is.
    """
    now = list(placed)
    targets = list(range(max(placed) + 1, shards)) or list(range(shards))
    load = [0] * shards
    owned: dict[int, list[int]] = {s: [] for s in range(shards)}
    homeless = []
    for slot, shard in enumerate(now):
        if shard < shards:
            load[shard] += sizes.get(slot, 0)
            owned[shard].append(slot)
        else:
            homeless.append(slot)
    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        shard = min(range(shards), key=lambda s: (load[s], s))
        now[slot], load[shard] = shard, load[shard] + sizes.get(slot, 0)
        owned[shard].append(slot)
    for _ in range(len(now)):
        full = max(range(shards), key=lambda s: (load[s], -s))
        empty = min(targets, key=lambda s: (load[s], s))
        room = load[full] - load[empty]
        movable = [s for s in owned[full] if 0 < sizes.get(s, 0) < room]
        if not movable:
            break
        slot = min(movable, key=lambda s: (abs(room / 2 - sizes[s]), s))
        owned[full].remove(slot)
        owned[empty].append(slot)
        now[slot] = empty
        load[full] -= sizes[slot]
        load[empty] += sizes[slot]
    return now


def store_map(spark: SparkSession, placed: list[int], version: int, path: str) -> None:
    """Write one version of the map; a version that exists is left as it is and raises."""
    rows = [(version, slot, shard) for slot, shard in enumerate(placed)]
    spark.createDataFrame(rows, "version int, virtual_slot int, shard int").coalesce(1).write.mode(
        "errorifexists"
    ).parquet(f"{path}/version={version:06d}")


def read_map(spark: SparkSession, version: int, path: str) -> list[int]:
    rows = spark.read.parquet(f"{path}/version={version:06d}").orderBy("virtual_slot").collect()
    return [r["shard"] for r in rows]


def map_versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of the map below ``path``, oldest first."""
    names = [name for name in files.children(spark, path) if name.startswith("version=")]
    return sorted(int(n.split("=", 1)[1]) for n in names if files.exists(spark, f"{path}/{n}/_SUCCESS"))


def rebalance(spark: SparkSession, sizes: dict[int, int], path: str, slots: int = SLOTS, shards: int = SHARDS) -> int:
    """Edit the newest map for the present sizes and shards; the version that then holds.

    Without a map, version 0 deals the slots out evenly, as before any size is known.  An edit that moves
    nothing makes no version.
    """
    versions = map_versions(spark, path)
    if not versions:
        store_map(spark, first_map({}, slots, shards), 0, path)
        versions = [0]
    placed = read_map(spark, versions[-1], path)
    edited = edited_map(placed, sizes, shards)
    if edited == placed:
        return versions[-1]
    store_map(spark, edited, versions[-1] + 1, path)
    return versions[-1] + 1


def shard_rows(slotted: DataFrame, sizes: DataFrame, placed: list[int]) -> DataFrame:
    """Rows with their shard and their place in it: ``slot`` counts from 0 in each shard without gaps.

    A row's place is its rank within its virtual slot plus the rows of earlier slots of the shard, so no
    task holds more than one virtual slot.  Repeated rows take different places; equal rows are ordered
    by id, crc and size, nulls first.
    """
    table = F.split(F.lit(",".join(map(str, placed))), ",").cast("array<int>")
    in_order = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "virtual_slot", "rows", F.element_at(table, F.col("virtual_slot") + 1).alias("shard")
    ).select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(in_order), F.lit(0)).alias("before"))
    rank = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    ranked = slotted.withColumn("_rank", F.row_number().over(rank) - 1)
    # One row for each virtual slot, never more than the fixed number of slots.
    return ranked.join(F.broadcast(starts), "virtual_slot").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("before") + F.col("_rank")).cast("long").alias("slot"),
        "virtual_slot",
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, maps: str | None = None) -> DataFrame:
    """All rows of ``docs`` in ``shards`` shards of nearly equal bytes, by the newest version of the map in ``maps``.

    The map is edited first if sizes or ``shards`` call for it, stored as the next version and read from there;
    without ``maps`` it lives in a new shared folder.  Size is the UTF-8 length of the text plus one; a null
    text has size 1 and crc 0.  Rows with the same id share a virtual slot; other columns are not read.  An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    maps = maps or shared_dir(spark, "slot-map")
    slotted = with_slots(docs, slots)
    sizes = slot_bytes(slotted)
    known = {r["virtual_slot"]: r["bytes"] for r in sizes.collect()}  # one entry a slot, `slots` at most
    version = rebalance(spark, known, maps, slots, shards)
    return shard_rows(slotted, sizes, read_map(spark, version, maps)).select(
        "*",
        F.lit("bytes").alias("law"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.lit(version).alias("map_version"),
    )
