"""Sharding by fixed virtual slots.

Every record is hashed into one of some thousands of slots. Bytes and rows are added up per slot, and a versioned table
says which shard each slot belongs to. Records never move between slots; balancing or growing edits the slot table only,
so the work of a change is the work of the moved slots. All steps are DataFrame operations: records are read once, the
slot tables have a fixed number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from agoralake.llm.common import unpacked

SLOTS = 4096
SHARDS = 40
GROWN = 5       # one of so many shards is added by an edit of the slot table
ROW_BYTES = 16  # counted for each record besides its text


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_crc(text: Column) -> Column:
    return F.coalesce(F.crc32(text), F.lit(0)).cast("long")


def record_slot(slots: int = SLOTS) -> Column:
    """The slot of a record with columns doc_id and text. Rows that repeat each other whole share a slot."""
    return F.pmod(F.xxhash64(F.col("doc_id"), text_crc(F.col("text")), text_bytes(F.col("text"))), F.lit(slots)).cast("int")


def slot_totals(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes, rows) for all slots, the empty ones included, from (virtual_slot, size)."""
    spark = records.sparkSession
    got = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    grid = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return grid.join(got, "virtual_slot", "left").select(
        "virtual_slot", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("rows", F.lit(0)).alias("rows"))


def slot_map(totals: DataFrame, shards: int = SHARDS, current: DataFrame | None = None) -> DataFrame:
    """(virtual_slot, shard, bytes, rows): ``current`` edited so that the shards' bytes are near equal.

    A shard gives up slots beyond the mean; the slots given up, and those without a shard, go largest first to the shard
    that holds least. Without ``current`` all slots are dealt. Slots of shards that exist no more are dealt anew. The
    dealing is a fold over the slots, whose number is fixed.
    """
    loads = totals.select("virtual_slot", "rows", "bytes", (F.col("bytes") + 1).alias("w"))
    if current is None:
        placed = loads.withColumn("shard", F.lit(None).cast("int"))
    else:
        placed = loads.join(F.broadcast(current.select("virtual_slot", "shard")), "virtual_slot", "left")
        placed = placed.withColumn("shard", F.when(F.col("shard") < shards, F.col("shard")))
        mean = F.ceil(loads.agg(F.sum("w")).scalar() / F.lit(shards))
        run = W.partitionBy("shard").orderBy(F.desc("w"), "virtual_slot").rowsBetween(W.unboundedPreceding, 0)
        placed = placed.withColumn("shard", F.when(F.sum("w").over(run) <= mean, F.col("shard")))
    kept = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.aggregate(
        "all", F.lit(0).cast("long"), lambda t, x: t + F.when(x["shard"] == s, x["w"]).otherwise(F.lit(0).cast("long"))))
    one = placed.agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("w")).alias("order"), "virtual_slot", "w", "shard"))).alias("all"))
    free = F.filter("all", lambda x: x["shard"].isNull())
    start = F.struct(kept.alias("loads"), F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("dealt"))

    def deal(acc: Column, x: Column) -> Column:
        best = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return F.struct(
            F.transform(acc["loads"], lambda load, i: F.when(i == best, load + x["w"]).otherwise(load)).alias("loads"),
            F.concat(acc["dealt"], F.array(F.struct(x["virtual_slot"].alias("virtual_slot"), best.alias("shard")))).alias("dealt"))

    dealt = one.select(F.explode(F.concat(
        F.aggregate(free, start, deal)["dealt"],
        F.transform(F.filter("all", lambda x: x["shard"].isNotNull()),
                    lambda x: F.struct(x["virtual_slot"].alias("virtual_slot"), x["shard"].alias("shard"))))).alias("x"))
    return dealt.select("x.virtual_slot", "x.shard").join(F.broadcast(totals), "virtual_slot")


def save_map(mapping: DataFrame, path: str, version: int) -> None:
    """Store one version of the slot table; a version that exists is never overwritten."""
    mapping.coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int, bytes long, rows long").parquet(f"{path}/version={version}")


def assign(records: DataFrame, mapping: DataFrame) -> DataFrame:
    """``records`` (with virtual_slot) and their shard. The slot table has a fixed number of rows, so it is broadcast."""
    return records.join(F.broadcast(mapping.select("virtual_slot", "shard")), "virtual_slot")


def positions(records: DataFrame, mapping: DataFrame) -> DataFrame:
    """``records`` (doc_id, size, text_crc32, virtual_slot, shard) and ``slot``: the place in the shard, without gaps.

    Rows are numbered inside their virtual slot, after all rows of the shard's earlier slots; no task holds a shard.
    """
    before = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)
    starts = mapping.select("virtual_slot", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    inside = W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return records.withColumn("n", F.row_number().over(inside)).join(F.broadcast(starts), "virtual_slot").withColumn(
        "slot", (F.col("first") + F.col("n") - 1).cast("long")).drop("n", "first")


def shard_documents(documents: DataFrame, path: str, version: int = 1, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot) for every row of ``documents``.

    The thin rows are written once under ``path``, so whole texts are read once, and with them two versions of the slot table:
    one for a fifth fewer shards, and that one edited for all of them, which decides. A null text has no
    bytes and check sum 0; an empty table gives no rows; rows that repeat each other share a slot and keep a place each;
    other columns are not read.
    """
    spark = documents.sparkSession
    documents.select(
        "doc_id", (text_bytes(F.col("text")) + ROW_BYTES).alias("size"), text_crc(F.col("text")).alias("text_crc32"),
        record_slot(slots).alias("virtual_slot")).write.parquet(f"{path}/records")
    thin = spark.read.schema("doc_id long, size long, text_crc32 long, virtual_slot int").parquet(f"{path}/records")
    # The table is dealt for fewer shards first and then edited, as when shards are added: rows move with their slots only.
    totals, before = slot_totals(thin, slots), max(1, shards - shards // GROWN)
    save_map(slot_map(totals, before), f"{path}/map", version - 1)
    save_map(slot_map(totals, shards, load_map(spark, f"{path}/map", version - 1)), f"{path}/map", version)
    mapping = load_map(spark, f"{path}/map", version)
    return positions(assign(thin, mapping), mapping).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def sharded_documents(documents: DataFrame, path: str, version: int = 1, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``documents`` with virtual_slot and shard; the slot table is stored under ``path``. Texts are not shuffled.

    Columns of these two names are replaced, others may have any name. A null text has no bytes, rows that repeat each other
    share a slot, and an empty table gives no rows.
    """
    slot = record_slot(slots).alias("virtual_slot")
    sized = documents.select((text_bytes(F.col("text")) + ROW_BYTES).alias("size"), slot)
    save_map(slot_map(slot_totals(sized, slots), shards), path, version)
    mapping = load_map(documents.sparkSession, path, version)
    rows = documents.select(slot, F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    return unpacked(assign(rows, mapping), documents.columns, virtual_slot=F.col("virtual_slot"), shard=F.col("shard"))
