"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agoralake.session import new_work_path, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BROADCAST_BYTES = 32 << 20  # above it the plain shuffled join is used


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the counted rows fit the limit; otherwise Spark joins by shuffle.

    ``df`` should be stored: it is counted here.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def packed(documents: DataFrame) -> DataFrame:
    """Whole rows as one column ``row``, so that no column of theirs can meet a name of an operator's own."""
    return documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))


def unpacked(rows: DataFrame, columns: list[str], **own: Column) -> DataFrame:
    """``columns`` of packed rows again. ``own`` columns take the place of those of their name, or follow."""
    kept = [own.pop(c).alias(c) if c in own else F.col("row")[c].alias(c) for c in columns]
    return rows.select(*kept, *[c.alias(name) for name, c in own.items()])


def parts_for(spark: SparkSession, total_bytes: int, each: int) -> int:
    """Partitions so that each holds about ``each`` bytes, and no fewer than the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total_bytes) // each))


def stored_by(df: DataFrame, name: str, key: str, parts: int, unique: bool = False) -> DataFrame:
    """As ``stored``, in ``parts`` buckets of ``key``: later joins on it leave these rows where they are and move the other side.
    ``unique`` keeps one row of each key."""
    spark = df.sparkSession
    path = new_work_path(spark, name)
    table = "work_" + path.rsplit("/", 1)[1].replace("-", "_")
    rows = df.repartition(parts, key)
    (rows.dropDuplicates([key]) if unique else rows).write.bucketBy(parts, key).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long); component is the smallest node reachable.

    Alternating large-star and small-star steps on (u, v) with v < u. Each is a map-side combined minimum per node joined
    back to the edges, so a node with very many neighbours is split like any skewed join. Every round's edges are a
    written table; the rounds grow with the logarithm of the longest path. No edges give no rows.
    """
    flat = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    flat = stored(flat, name)

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(flat)
    while seen[0]:
        both = flat.union(flat.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        flat = stored(small, name)
        now = mark(flat)
        if now == seen:
            break
        seen = now
    roots = flat.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return flat.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
