"""Shards through fixed virtual slots.

A record's id and text hash into one of ``SLOTS`` virtual slots, for good; records that repeat both are dealt over the
slots one by one, so that neither a missing id nor a repeated row fills a slot. A map gives each slot a shard; it carries
a version, and rebalancing edits it: slots move from the fullest shard to the emptiest until no move helps, and everything
else stays where it is. What decides is the bytes of each slot, one aggregate over all records. The map has ``SLOTS`` rows
whatever the data, so editing it on the driver and broadcasting it are bounded.

Within a shard, records take consecutive places from 0: in order of slot, then block of a slot, then hash. The places come
from counts of blocks, so that neither a shard nor a slot is a single task's sort.

Defined cases: a null text has 8 bytes and the checksum of no bytes; a null id hashes like the text "null"; repeated rows
hold a place each, and which of them falls into which slot follows their place in the table; an empty table gives an
empty result and a version-1 map. With ``map_path`` the stored map is read back, edited for the bytes of now and, if it
changed, stored as the next version; else the map starts anew.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from arpent.plans.staging import staged

SLOTS = 8192
SHARDS = 24
BLOCKS = 16
#: Moves stop once the fullest shard is within this part of the mean.
TOLERANCE = 0.0005


def records(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each record's size, checksum and virtual slot: no text from here on."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        *keep, (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64(key, F.crc32(body)).alias("_record"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = staged(rows, "rows")
    again = rows.groupBy("_record").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rows = rows.join(again, "_record", "left")
    rows = rows.withColumn("_order", F.when(F.col("_n").isNull(), F.col("_record")).otherwise(F.xxhash64("_record", F.pmod("_row", "_n"))))
    rows = rows.withColumn("vslot", F.pmod("_order", F.lit(SLOTS)).cast("int")).drop("_record", "_row", "_n")
    return rows.withColumn("_block", F.pmod(F.shiftright("_order", 20), F.lit(BLOCKS)).cast("int"))


def first_map(shards: int = SHARDS) -> list[int]:
    """Version 0: slots dealt in turn."""
    return [k % shards for k in range(SLOTS)]


def rebalanced(slot_map: list[int], slot_bytes: dict[int, int], shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[int]:
    """The next version: moves, and exchanges where no move helps, between the fullest and the emptiest shard."""
    slot_map, load, held = [s if s < shards else k % shards for k, s in enumerate(slot_map)], [0] * shards, defaultdict(dict)
    for slot, shard in enumerate(slot_map):
        load[shard] += slot_bytes.get(slot, 0)
        if slot_bytes.get(slot):
            held[shard][slot] = slot_bytes[slot]
    goal = sum(load) / shards
    for _ in range(4 * SLOTS):
        full, empty = max(range(shards), key=load.__getitem__), min(range(shards), key=load.__getitem__)
        gap = load[full] - load[empty]
        if gap <= tolerance * goal or gap < 2:
            break
        moved = _best(held[full], held[empty], gap)
        if moved is None:
            break
        out, back = moved
        for slot, old, new in ((out, full, empty), (back, empty, full)):
            if slot is not None:
                size = held[old].pop(slot)
                held[new][slot], slot_map[slot] = size, new
                load[old] -= size
                load[new] += size
    return slot_map


def _best(full: dict[int, int], empty: dict[int, int], gap: int) -> tuple[int, int | None] | None:
    """The move (slot out, none back) or exchange (slot out, slot back) whose net size is closest to half the gap."""
    import bisect

    back = sorted((size, slot) for slot, size in empty.items())
    best = (gap / 2, None)
    for slot, size in sorted(full.items()):
        off = abs(size - gap / 2)
        if size < gap and off < best[0]:
            best = (off, (slot, None))
        at = bisect.bisect_left(back, (size - gap / 2, -1))
        for k in (at - 1, at):
            if 0 <= k < len(back):
                net = size - back[k][0]
                if 0 < net < gap and abs(net - gap / 2) < best[0]:
                    best = (abs(net - gap / 2), (slot, back[k][1]))
    return best[1]


def map_table(spark: SparkSession, version: int, slot_map: list[int]) -> DataFrame:
    """One version of a map: (version, vslot, shard), a row a slot."""
    return spark.createDataFrame([(version, slot, shard) for slot, shard in enumerate(slot_map)], "version int, vslot int, shard int")


def save_map(spark: SparkSession, path: str, version: int, slot_map: list[int]) -> None:
    """Add a version to the history of a map; earlier versions stay readable."""
    map_table(spark, version, slot_map).coalesce(1).write.mode("append").parquet(path)  # a row a slot


def load_map(spark: SparkSession, path: str) -> tuple[int, list[int]] | None:
    """The newest version of a stored map and its number; none if nothing is stored there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    history = spark.read.schema("version int, vslot int, shard int").parquet(path)
    version = history.agg(F.max("version")).first()[0]
    rows = {r["vslot"]: r["shard"] for r in history.where(F.col("version") == version).collect()}  # a row a slot
    if sorted(rows) != list(range(SLOTS)):
        raise ValueError(f"version {version} of the map at {path} has not {SLOTS} slots")
    return version, [rows[k] for k in range(SLOTS)]


def shard(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), shards: int = SHARDS, map_path: str | None = None) -> DataFrame:
    """Every record with its shard and its place there, under the newest version of the map; sizes of shards come near
    equal (law ``bytes``). The map is a table at ``map_path``, or one in the shared folder that starts anew."""
    spark = docs.sparkSession
    rows = staged(records(docs, text, doc_id, keep), "records")
    blocks = rows.groupBy("vslot", "_block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    blocks = staged(blocks, "blocks")  # at most SLOTS x BLOCKS rows
    slot_bytes = {r["vslot"]: r["bytes"] for r in blocks.groupBy("vslot").agg(F.sum("bytes").alias("bytes")).collect()}
    stored = load_map(spark, map_path) if map_path else None
    version, before = stored or (0, first_map(shards))
    now = rebalanced(before, slot_bytes, shards)
    if stored is None or now != before:
        version += 1
        if map_path:
            save_map(spark, map_path, version, now)
    newest = staged(map_table(spark, version, now), "slotmap").drop("version")
    ahead = Window.partitionBy("shard").orderBy("vslot", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.join(newest, "vslot").withColumn("_ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).select("vslot", "_block", "shard", "_ahead")
    inside = Window.partitionBy("vslot", "_block").orderBy("_order", *keep)
    placed = rows.withColumn("_at", F.row_number().over(inside) - 1).join(starts, ["vslot", "_block"])
    return placed.select(
        *keep, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_at") + F.col("_ahead")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "vslot", F.lit(version).alias("map_version"),
    )
