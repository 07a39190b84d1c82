"""Sharding by fixed virtual slots [native].

Every record hashes to one of a fixed number of virtual slots.  A versioned
table maps slots to shards; rebalancing edits that table (moves some slots)
and never rehashes a record.  The map has one row per slot, so its size is
fixed by the ``slots`` parameter: the greedy edit runs over that many rows on
the driver and the map is broadcast.

Law ``bytes``: after the edit the shards hold near equal bytes, where a record
weighs the UTF-8 bytes of its text plus one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import clean_text, register, table

SLOTS = 4096
MAP_SCHEMA = "version int, vslot int, shard int"


class SlotMap:
    """Versioned slot-to-shard map stored under ``path``; a version is written
    once and never changed."""

    def __init__(self, spark: SparkSession, path: str, slots: int = SLOTS):
        self.spark, self.path, self.slots = spark, path.rstrip("/"), slots

    def write(self, version: int, shards: dict[int, int]) -> None:
        rows = [(version, s, shards[s]) for s in range(self.slots)]
        (self.spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.path}/version={version:06d}"))

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.path}/version={version:06d}")

    def initial(self, shards: int) -> dict[int, int]:
        return {s: s % shards for s in range(self.slots)}


def slot_of(key: str, slots: int = SLOTS):
    """Virtual slot of a key; fixed for ever, whatever the number of shards.
    NULL keys hash too (to one slot)."""
    return F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(slots)).cast("int")


def edit_map(current: dict[int, int], weight: dict[int, int], shards: int) -> dict[int, int]:
    """Move slots from shards above the mean to the lightest ones.

    A shard keeps its heaviest slots while they fit under the mean; the others
    are released and go, heaviest first, to the lightest shard.  Ties fall to
    the smaller slot and shard, so the edit is repeatable."""
    mean = sum(weight.values()) / shards
    load = [0] * shards
    out, released = {}, []
    for s in sorted(current, key=lambda s: (-weight.get(s, 0), s)):
        w, home = weight.get(s, 0), current[s]
        if home < shards and load[home] + w <= mean:
            load[home] += w
            out[s] = home
        else:
            released.append(s)
    for s in released:
        to = min(range(shards), key=lambda k: (load[k], k))
        load[to] += weight.get(s, 0)
        out[s] = to
    return out


def shard_by_slots(docs: DataFrame, shards: int, slots: int = SLOTS, id_col: str = "doc_id",
                   text_col: str = "text", path: str | None = None) -> DataFrame:
    """Assign every record a shard and a gapless place in it.

    Returns doc_id, size, text_crc32, shard, slot (place in the shard, from 0)
    and virtual_slot; other columns of ``docs`` are ignored, whatever their
    names.  NULL text weighs 1 and has the checksum of the empty text; NULL
    ids share one virtual slot; repeated rows each get a place; an empty table
    gives an empty result."""
    spark = docs.sparkSession
    text = clean_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                       slot_of(id_col, slots).alias("virtual_slot"))
    # One row per slot: at most ``slots`` rows reach the driver.
    stats = {r[0]: (r[1], r[2]) for r in rows.groupBy("virtual_slot")
             .agg(F.sum("size"), F.count(F.lit(1))).collect()}
    slot_map = SlotMap(spark, path or scratch_path(spark, "slot-map"), slots)
    first = slot_map.initial(shards)
    slot_map.write(1, first)
    slot_map.write(2, edit_map(first, {s: b for s, (b, _) in stats.items()}, shards))

    before: dict[int, int] = {}
    places = []
    for r in sorted(slot_map.read(2).collect(), key=lambda r: r["vslot"]):
        places.append((r["vslot"], r["shard"], before.get(r["shard"], 0)))
        before[r["shard"]] = before.get(r["shard"], 0) + stats.get(r["vslot"], (0, 0))[1]
    placed = spark.createDataFrame(places, "virtual_slot int, shard int, place long")
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("nth", F.row_number().over(inside) - 1)
            .join(F.broadcast(placed), "virtual_slot")
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("place") + F.col("nth")).cast("long").alias("slot"), "virtual_slot"))


@register("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_by_slots(table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
