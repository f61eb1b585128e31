"""Sharding by fixed virtual slots (DataFrame functions only).

Every record belongs for ever to one of a few thousand virtual slots, by a hash of its id.
Bytes are summed per slot, and a small versioned table maps slots to shards. Rebalancing
edits that table and never looks at the records: a new version moves a few slots.

Law ``bytes``: the sums of bytes of the shards are near equal. The map gives slots to shards
largest first, each to the shard with the fewest bytes so far, so two shards differ by no
more than one slot.

Defined results: a null text has size 1 and the checksum of the empty text; a null id is
placed by its text; repeated rows share a slot and follow one another; an empty table gives
no rows and an empty shard map still covers all slots. Other columns of the input are kept
unless they bear a name of a result column, which then holds the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 8192  # fixed for the life of a corpus
LAW = "bytes"


def record_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")


def text_crc32(text: str = "text") -> Column:
    return F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).cast("long")


def virtual_slot(doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> Column:
    """The record's slot: a hash of the id alone (of the text where the id is null)."""
    key = F.when(F.col(doc_id).isNull(), F.xxhash64(F.coalesce(F.col(text), F.lit("")))).otherwise(F.xxhash64(F.col(doc_id)))
    return F.pmod(key, F.lit(slots)).cast("int")


def slot_sizes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(vslot, bytes, records) for all ``slots`` slots, empty ones included. ``records`` has vslot and size."""
    sums = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records"))
    return (records.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
            .join(sums, "vslot", "left")
            .select("vslot", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("records", F.lit(0)).alias("records")))


def plan_map(sizes: DataFrame, shards: int, version: int = 1) -> DataFrame:
    """(version, vslot, shard, bytes, records): largest slot first, to the emptiest shard. The slots, a
    fixed few thousand rows, are folded in one row with the shards' loads as the state."""
    ordered = sizes.agg(F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "vslot", "records"))).alias("s"))
    start = F.struct(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: F.struct(F.lit(0).cast("long").alias("load"), k.alias("shard"))).alias("loads"),
                     F.expr("cast(array() as array<int>)").alias("chosen"))

    def give(state: Column, slot: Column) -> Column:
        to = F.array_min(state["loads"])["shard"]
        loads = F.transform(state["loads"], lambda x: F.struct(F.when(x["shard"] == to, x["load"] - slot["less"]).otherwise(x["load"]).alias("load"), x["shard"].alias("shard")))
        return F.struct(loads.alias("loads"), F.concat(state["chosen"], F.array(to)).alias("chosen"))

    return (ordered.select("s", F.aggregate("s", start, give)["chosen"].alias("shard"))
            .select(F.explode(F.arrays_zip("s", "shard")).alias("x"))
            .select(F.lit(version).alias("version"), F.col("x.s.vslot").alias("vslot"), F.col("x.shard").alias("shard"),
                    (-F.col("x.s.less")).alias("bytes"), F.col("x.s.records").alias("records")))


def grow_map(shard_map: DataFrame, shards: int) -> DataFrame:
    """The map's next version with one more shard, numbered ``shards``: every old shard hands over
    its last slots up to its share of the new shard; no other slot moves."""
    share = F.floor(F.sum("bytes").over(Window.partitionBy()) / (shards * (shards + 1)))
    upto = F.sum("bytes").over(Window.partitionBy("shard").orderBy(F.col("bytes"), F.col("vslot")))
    return (shard_map.withColumn("_moves", (upto <= share) & (F.col("bytes") > 0))
            .select((F.col("version") + 1).alias("version"), "vslot", F.when(F.col("_moves"), F.lit(shards)).otherwise(F.col("shard")).alias("shard"),
                    "bytes", "records"))


def store_map(shard_map: DataFrame, path: str) -> None:
    """Append a version to the stored map."""
    shard_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(path).where(F.col("version") == version).select("version", "vslot", "shard", "bytes", "records")


def place(records: DataFrame, shard_map: DataFrame) -> DataFrame:
    """Each record with its shard and its gapless place in the shard: the records of the shard's
    earlier slots (from the map) plus its place in its own slot, in id order."""
    before = F.sum("records").over(Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1))
    offsets = shard_map.select("vslot", F.col("shard").cast("int").alias("shard"), F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("vslot").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size"))
    return (records.withColumn("_own", own).join(F.broadcast(offsets), "vslot")  # a fixed number of rows
            .withColumn("slot", (F.col("_before") + F.col("_own") - 1).cast("long")).drop("_before", "_own"))


def shard_records(docs: DataFrame, shards: int, map_path: str, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot, shard, slot, next_shard) of every record. Versions 1 (``shards``
    shards) and 2 (one more) of the map are stored at ``map_path`` and read from there."""
    spark = docs.sparkSession
    records = docs.select("doc_id", record_size().alias("size"), text_crc32().alias("text_crc32"), virtual_slot(slots=slots).alias("vslot"))
    store_map(plan_map(slot_sizes(records, slots), shards), map_path)
    now = load_map(spark, map_path, 1)
    store_map(grow_map(now, shards), map_path)
    grown = load_map(spark, map_path, 2).select("vslot", F.col("shard").cast("int").alias("next_shard"))
    return place(records, now).join(F.broadcast(grown), "vslot")
