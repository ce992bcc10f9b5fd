"""Shards by fixed virtual slots: rows hash into slots, slots carry bytes, a versioned map sends slots to shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Virtual slots; fixed for the life of a corpus. The slot map has this many rows, whatever the number of documents.
SLOTS = 8192
ROW_OVERHEAD = 16


def with_slot(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 16 a row), text_crc32 and virtual_slot of every row.

    A NULL text counts no bytes and has the checksum of no bytes. Rows without doc_id spread over the slots by text.
    Other columns of docs are left out, so they cannot clash.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), text))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(key, F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Bytes and rows of each slot in use; added up map-side."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def even_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: ranges of slots, blind to bytes."""
    return spark.range(slots).select(
        F.col("id").cast("int").alias("virtual_slot"),
        F.expr(f"cast(id * {shards} div {slots} as int)").alias("shard"),
        F.lit(0).alias("version"),
    )


def rebalanced(slot_map: DataFrame, stats: DataFrame, shards: int) -> DataFrame:
    """The next version of a slot map, edited so that shards carry about equal bytes.

    Each shard keeps its largest slots up to the mean load and gives up the rest; slots of shards that no longer exist
    are given up too. What was given up goes, largest first, to the shard with the least bytes so far. All of this
    works on one row per slot, so its size is fixed.
    """
    known = slot_map.join(stats, "virtual_slot", "left").select(
        "virtual_slot", "shard", "version", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")
    )
    by_size = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    kept = (F.col("shard") < shards) & (F.sum("bytes").over(by_size) * shards <= F.sum("bytes").over(Window.partitionBy()))
    marked = known.select("virtual_slot", "shard", "bytes", "version", kept.alias("kept"))
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda i: F.aggregate(
            F.filter("all", lambda x: x["kept"] & (x["shard"] == i)), F.lit(0).cast("long"), lambda s, x: s + x["bytes"]
        ),
    )
    state = marked.agg(
        F.max("version").alias("version"),
        F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("key"), "virtual_slot", "shard", "bytes", "kept"))).alias("all"),
    ).select("version", "all", loads.alias("loads"))

    def place(now, slot):
        to = (F.array_position(now["loads"], F.array_min(now["loads"])) - 1).cast("int")
        grown = F.transform(now["loads"], lambda x, i: F.when(i == to, x + slot["bytes"]).otherwise(x))
        return F.struct(grown.alias("loads"), F.concat(now["placed"], F.array(F.struct(slot["virtual_slot"], to.alias("shard")))).alias("placed"))

    nothing = F.expr("cast(array() as array<struct<virtual_slot:int,shard:int>>)")
    placed = F.aggregate(
        F.filter("all", lambda x: ~x["kept"]), F.struct("loads", nothing.alias("placed")), place, lambda end: end["placed"]
    )
    stays = F.transform(F.filter("all", lambda x: x["kept"]), lambda x: F.struct(x["virtual_slot"], x["shard"]))
    return state.select(F.explode(F.concat(stays, placed)).alias("s"), (F.col("version") + 1).alias("version")).select(
        F.col("s.virtual_slot"), F.col("s.shard"), "version"
    )


def save_map(slot_map: DataFrame, path: str) -> int:
    """Store a version of the map in its own directory and return its number; other versions stay.

    Storing a version again, as a retry does, replaces it.
    """
    version = slot_map.agg(F.max("version")).first()[0]
    slot_map.select("virtual_slot", "shard").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")
    return version


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """A stored version of the map, the newest by default; None if nothing is stored under path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where) or not len(files.listStatus(where)):
        return None
    maps = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    wanted = maps.agg(F.max("version")).first()[0] if version is None else version
    return maps.where(F.col("version") == wanted).select("virtual_slot", "shard", "version")


def shard_rows(rows: DataFrame, slot_map: DataFrame, stats: DataFrame) -> DataFrame:
    """Rows with shard and slot, their place in the shard: gapless from 0, by virtual slot, then doc_id.

    Places are counted inside each virtual slot and moved by the rows of the shard's earlier slots, so no task sees a
    whole shard. The map is broadcast: it has one row per virtual slot.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(stats, "virtual_slot").select(
        "virtual_slot", "shard", "version", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return rows.join(F.broadcast(starts), "virtual_slot").withColumn(
        "slot", F.row_number().over(inside) - F.lit(1).cast("long") + F.col("start")
    )


def sharded(docs: DataFrame, shards: int, slots: int = SLOTS, maps: str | None = None) -> DataFrame:
    """Every row of docs with its shard under the rebalanced map, and its place there.

    The newest map stored under maps is edited, the result stored there as the next version and read back; where none
    is stored, an even map comes first, as version 0. Without maps an even map is edited and nothing stored.

    Equal rows and equal texts stay separate rows: doc_id decides the slot, so equal texts of different doc_ids may go
    to different shards, and rows that share a doc_id go to one. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = with_slot(docs, slots)
    stats = slot_bytes(rows)
    now = load_map(spark, maps) if maps else None
    if now is None:
        now = even_map(spark, shards, slots)
        if maps:
            save_map(now, maps)
    following = rebalanced(now, stats, shards)
    if maps:
        following = load_map(spark, maps, save_map(following, maps))
    return shard_rows(rows, following, stats)
