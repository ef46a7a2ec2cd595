"""Shards by fixed virtual slots: keys hash to slots for good, and a versioned map says which shard owns a slot.

Only DataFrame functions. Adding or relieving a shard edits the map (thousands of rows, whatever the data), never the hash, so no key
moves but those in edited slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_folder, stored

#: Slots; fixed for the life of a data set.
SLOTS = 4096


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key; a null key has one too."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def owner(slot: Column, shards: int) -> Column:
    """Shard whose draw for the slot is largest. One more shard can only win slots, so no slot moves between old shards."""
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda shard: F.struct(F.xxhash64(slot, shard).alias("draw"), shard.alias("shard"))
    )
    return F.array_max(draws)["shard"]


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: (version, virtual_slot, shard). A function of the two counts alone."""
    slot = F.col("id").cast("int")
    return spark.range(0, slots, 1, 1).select(F.lit(1).alias("version"), slot.alias("virtual_slot"), owner(slot, shards).alias("shard"))


def grow(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version, for `shards` shards instead of one less: the new shard takes the slots it wins, the others stay."""
    won = owner(F.col("virtual_slot"), shards) == shards - 1
    return slot_map.select(
        (F.col("version") + 1).alias("version"), "virtual_slot", F.when(won, shards - 1).otherwise(F.col("shard")).alias("shard")
    )


def slot_sizes(placed: DataFrame) -> DataFrame:
    """(virtual_slot, slot_bytes, slot_rows) of rows that carry `virtual_slot` and `size`."""
    return placed.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))


def rebalance(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version, with bytes evened out by moving as little as needed.

    A shard above the mean gives up its smallest slots, those that stand beyond the mean in order of falling size; shards below the mean
    take them in turn until filled. All windows here are over the slots, whose number is fixed.
    """
    known = slot_map.join(F.broadcast(sizes), "virtual_slot", "left").withColumn("slot_bytes", F.coalesce("slot_bytes", F.lit(0)))
    mean = F.sum("slot_bytes").over(Window.partitionBy()) / F.lit(shards)
    largest_first = [F.col("slot_bytes").desc(), F.col("virtual_slot")]
    filled = F.sum("slot_bytes").over(Window.partitionBy("shard").orderBy(*largest_first))
    marked = known.withColumn("mean", mean).withColumn("given", filled > F.col("mean"))
    kept = marked.filter(~F.col("given")).groupBy("shard").agg(F.sum("slot_bytes").alias("kept"))
    every = slot_map.sparkSession.range(0, shards, 1, 1).select(F.col("id").cast("int").alias("shard"))
    room = every.join(F.broadcast(kept), "shard", "left").join(F.broadcast(marked.select("mean").distinct()))
    room = room.withColumn("room", F.col("mean") - F.coalesce("kept", F.lit(0)))
    room = room.withColumn("upto", F.sum("room").over(Window.partitionBy().orderBy("shard")))
    takers = room.agg(F.sort_array(F.collect_list(F.struct("upto", "shard"))).alias("takers"))
    start = F.sum("slot_bytes").over(Window.partitionBy("given").orderBy(*largest_first)) - F.col("slot_bytes")
    placed = marked.withColumn("start", start).join(F.broadcast(takers))
    taker = F.coalesce(F.filter("takers", lambda t: t["upto"] > F.col("start"))[0], F.element_at("takers", -1))["shard"]
    return placed.select(
        (F.col("version") + 1).alias("version"), "virtual_slot", F.when(F.col("given"), taker).otherwise(F.col("shard")).alias("shard")
    )


def save_map(slot_map: DataFrame, path: str) -> None:
    """Adds a version to the stored map; earlier versions stay readable."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    schema = "virtual_slot int, shard int, version int"
    return spark.read.schema(schema).parquet(path).filter(F.col("version") == version).select("version", "virtual_slot", "shard")


def positions(placed: DataFrame) -> DataFrame:
    """Adds `slot`: the place of a row in its shard, from 0 without gaps.

    Rows are numbered within (shard, `part`), where `part` is the partition they were read in, and shifted by the counts of the parts
    before, so no task numbers a whole shard. `placed` must be stored, since a part must not change between the two uses.
    """
    cell = ["shard", "part"]
    counts = placed.groupBy(*cell).agg(F.count("*").alias("n"))
    before = (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before")
    number = F.row_number().over(Window.partitionBy(*cell).orderBy("doc_id", "text_crc32", "size"))
    numbered = placed.withColumn("number", number).join(counts.select(*cell, before), cell)
    return numbered.withColumn("slot", F.col("before") + F.col("number") - 1).drop("number", "before", "part")


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS) -> DataFrame:
    """Shard of every row, now (`shard`) and with one shard more (`grown_shard`), by `doc_id` and the number of shards alone.

    Law `key`: rows of one `doc_id` share a shard; rows of equal texts need not. Null texts have size 8 and the checksum of the empty
    text; rows with a null `doc_id` share one slot. Repeated rows each keep a row and a place. Other columns of `docs` are not read. An
    empty table gives no rows. Returns doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard, virtual_slot,
    slot_bytes (bytes in that virtual slot), map_version, grown_version.
    """
    spark, text = docs.sparkSession, F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        virtual_slot(F.col("doc_id"), slots).alias("virtual_slot"),
        F.spark_partition_id().alias("part"),
    )
    rows = stored(rows, "shard-rows")
    path = new_folder(spark, "slot-map")
    save_map(first_map(spark, shards, slots), path)
    save_map(grow(load_map(spark, path, 1), shards + 1), path)
    now = load_map(spark, path, 1).withColumnRenamed("version", "map_version")
    then = load_map(spark, path, 2).select("virtual_slot", F.col("version").alias("grown_version"), F.col("shard").alias("grown_shard"))
    edited = now.join(F.broadcast(then), "virtual_slot").join(F.broadcast(slot_sizes(rows)), "virtual_slot", "left")
    placed = positions(rows.join(F.broadcast(edited), "virtual_slot"))  # one row per slot, whatever the data
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard",
        "virtual_slot", "slot_bytes", "map_version", "grown_version",
    )
