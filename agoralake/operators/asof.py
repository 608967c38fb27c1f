"""As-of join: for each left row, the latest right row at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str], block_days: int = 30, fallback_first: bool = False,
              block_seconds: int = 3600) -> DataFrame:
    """Left join of ``values`` from the latest right row with ``right_time <= left_time`` and equal ``by``.

    The time axis of every key is cut into blocks: of ``block_days`` for dates, of ``block_seconds`` where both times are
    timestamps, so a busy key's day is spread too. Inside a block the answer is a running ``last`` over
    the rows of both sides; across blocks a small table carries the last right row of each block forward. A key that
    holds most rows is thus spread over its blocks, and each side is first reduced to one row per (key, time).

    With ``fallback_first`` a left row before every right row of its key takes the key's first right row.
    """
    by = list(by)
    day = lambda c: F.col(c).cast("date")
    if all(df.schema[c].dataType.typeName().startswith("timestamp") for df, c in ((left, left_time), (right, right_time))):
        block = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (block_seconds * 1_000_000))
    else:
        block = lambda c: F.floor(F.datediff(day(c), F.lit("1970-01-01").cast("date")) / block_days)

    packed = F.struct(F.col(right_time).alias("_at"), *[F.col(v) for v in values])
    right_rows = (
        right.where(F.col(right_time).isNotNull())
        .groupBy(*by, F.col(right_time).alias("_t")).agg(F.max(packed).alias("_v"))
        .withColumn("_block", block("_t"))
    )
    left_keys = (
        left.where(F.col(left_time).isNotNull())
        .select(*by, F.col(left_time).alias("_t")).distinct().withColumn("_block", block("_t"))
    )

    # Last right row of each block, carried into later blocks. Rows here: blocks per key, bounded by the calendar.
    blocks = left_keys.select(*by, "_block").distinct()
    block_last = right_rows.groupBy(*by, "_block").agg(F.max_by("_v", "_t").alias("_v"))
    spine = blocks.join(block_last, [*by, "_block"], "full")
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = spine.select(*by, "_block", F.last("_v", ignorenulls=True).over(before).alias("_carry"))

    # Right rows sort before left rows of the same time, so "at or before" holds.
    both = (
        right_rows.select(*by, "_block", "_t", "_v", F.lit(0).alias("_side"))
        .unionByName(left_keys.select(*by, "_block", "_t", F.lit(None).alias("_v"), F.lit(1).alias("_side")))
    )
    inside = Window.partitionBy(*by, "_block").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        both.withColumn("_hit", F.last("_v", ignorenulls=True).over(inside)).where(F.col("_side") == 1)
        .join(carried, [*by, "_block"], "left")
        .select(*by, "_t", F.coalesce("_hit", "_carry").alias("_hit"))
    )
    if fallback_first:
        first = right_rows.groupBy(*by).agg(F.min_by("_v", "_t").alias("_first"))
        found = found.join(first, by, "left") if by else found.withColumn(
            "_first", right_rows.agg(F.min_by("_v", "_t")).scalar())
        found = found.withColumn("_hit", F.coalesce("_hit", "_first"))
    picked = found.select(
        *by, F.col("_t").alias(left_time), F.col("_hit._at").alias(f"asof_{right_time}"),
        *[F.col(f"_hit.{v}").alias(v) for v in values],
    )
    return left.join(picked, [*by, left_time], "left")


def forward_fill(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], by: Sequence[str] = (),
                 default: Column | None = None) -> DataFrame:
    """Last known value of each column. Without ``by`` the rows must be windows of a calendar, not posts."""
    window = Window.partitionBy(*by).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(c, ignorenulls=True).over(window) for c in columns}
    if default is not None:
        filled = {c: F.coalesce(v, default) for c, v in filled.items()}
    return df.withColumns(filled)
