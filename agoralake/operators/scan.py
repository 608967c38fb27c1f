"""Running values along ordered keys of any length, as a prefix scan in two passes.

Rows are range partitioned by key *and* order, so a key that holds most of the table is cut into pieces of about the size
of any other partition. Inside a piece the running value is a window; one small row per key and piece carries the values
of the pieces before it. The largest group any task sees is a piece, never a key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from agoralake.session import stored

PIECE = "_piece"


def in_pieces(df: DataFrame, by: Sequence[str], order: Sequence[str], parts: int | None = None, name: str = "pieces") -> DataFrame:
    """The rows with ``_piece``, which rises along (by, order); stored, as every later step needs the same pieces.

    Rows equal in all of these columns stay together, so ``order`` should tell rows of a large key apart. NULLs come first.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*by, *order)]
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    return stored(ranged.withColumn(PIECE, F.spark_partition_id()), name)


def _combined(kind: str, before: Column, inside: Column) -> Column:
    if kind == "last":
        return F.coalesce(inside, before)
    if kind == "bit_xor":
        return F.coalesce(before, F.lit(0)).bitwiseXOR(F.coalesce(inside, F.lit(0)))
    return F.when(before.isNotNull() | inside.isNotNull(), F.coalesce(before, F.lit(0)) + F.coalesce(inside, F.lit(0)))


def running(rows: DataFrame, by: Sequence[str], order: Sequence[str], values: dict[str, tuple[str, str | None]],
            inclusive: bool = True, per_key: DataFrame | None = None) -> DataFrame:
    """``rows`` of ``in_pieces`` with a running value per entry of ``values``: new column -> (kind, column).

    Kinds: ``number`` (rows so far, no column), ``sum``, ``bit_xor`` and ``last`` (last value that is not NULL). With
    ``inclusive=False`` the row itself is left out. ``per_key`` holds columns of one row per key that are wanted beside:
    they travel with the pieces, so a long key is not joined whole. An empty table gives no rows.
    """
    by, own = list(by), f"_{uuid.uuid4().hex[:8]}"  # a prefix that no column of the caller has
    ordered = [F.col(c).asc_nulls_first() for c in order]
    place = F.struct(*order)
    inner = Window.partitionBy(*by, PIECE).orderBy(*ordered).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    before = Window.partitionBy(*by).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    totals, carries, inside = [], [], {}
    for i, (kind, column) in enumerate(values.values()):
        c = F.lit(1).cast("bigint") if kind == "number" else F.col(column)
        if kind == "last":
            totals.append(F.max_by(c, F.when(c.isNotNull(), place)).alias(f"{own}_t{i}"))
            carries.append(F.last(f"{own}_t{i}", ignorenulls=True).over(before).alias(f"{own}_c{i}"))
            inside[f"{own}_i{i}"] = F.last(c, ignorenulls=True).over(inner)
        else:
            total = F.bit_xor if kind == "bit_xor" else F.sum
            totals.append(total(c).alias(f"{own}_t{i}"))
            carries.append(total(f"{own}_t{i}").over(before).alias(f"{own}_c{i}"))
            inside[f"{own}_i{i}"] = total(c).over(inner)
    carried = rows.groupBy(*by, PIECE).agg(*totals).select(*by, PIECE, *carries)
    extra = [] if per_key is None else [c for c in per_key.columns if c not in by]
    if per_key is not None:
        carried = carried.join(per_key, by, "left")
    carried = carried.select(*[F.col(c).alias(f"{own}_k{i}") for i, c in enumerate(by)], F.col(PIECE).alias(f"{own}_p"),
                             *[f"{own}_c{i}" for i in range(len(values))], *extra)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{own}_k{i}")) for i, c in enumerate(by)], F.col(PIECE) == F.col(f"{own}_p"))
    joined = rows.withColumns(inside).join(carried, same)
    return joined.select(*rows.columns, *extra, *[
        _combined(kind, F.col(f"{own}_c{i}"), F.col(f"{own}_i{i}")).alias(out) for i, (out, (kind, _)) in enumerate(values.items())])


def fill_forward(df: DataFrame, columns: Sequence[str], order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Last known value of each column along each key, whatever the length of a key."""
    keys = list(by) or ["_all"]
    rows = in_pieces(df if by else df.withColumn("_all", F.lit(0)), keys, order, name="fill-forward")
    filled = running(rows, keys, order, {f"_f_{c}": ("last", c) for c in columns})
    return filled.select(*[F.col(f"_f_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def with_previous(df: DataFrame, columns: dict[str, str], order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """New column -> the value its column had in the row before that had one; NULL in the first rows of a key."""
    keys = list(by) or ["_all"]
    rows = in_pieces(df if by else df.withColumn("_all", F.lit(0)), keys, order, name="previous")
    out = running(rows, keys, order, {new: ("last", c) for new, c in columns.items()}, inclusive=False)
    return out.select(*df.columns, *columns)


def asof_scan(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str]) -> DataFrame:
    """As ``asof.asof_join``, for keys that may hold most rows within any span of time: both sides are one ordered table,
    and the last right row is carried along it. No block length has to fit the data.

    Right rows of one key and time count once (the greatest); left rows without a time keep NULLs.
    """
    by = list(by)
    packed = F.struct(F.col(right_time).alias("_at"), *[F.col(v) for v in values])
    kind = left.schema[left_time].dataType
    known = right.where(F.col(right_time).isNotNull()).groupBy(*by, F.col(right_time).cast(kind).alias("_t")).agg(F.max(packed).alias("_v"))
    asked = left.where(F.col(left_time).isNotNull()).select(*by, F.col(left_time).alias("_t")).distinct()
    both = known.select(*by, "_t", F.lit(0).alias("_side"), "_v").unionByName(
        asked.select(*by, "_t", F.lit(1).alias("_side"), F.lit(None).alias("_v")))
    keys = by or ["_all"]
    rows = in_pieces(both if by else both.withColumn("_all", F.lit(0)), keys, ["_t", "_side"], name="as-of")
    found = running(rows, keys, ["_t", "_side"], {"_hit": ("last", "_v")}).where(F.col("_side") == 1).select(
        *by, F.col("_t").alias(left_time), F.col("_hit._at").alias(f"asof_{right_time}"), *[F.col(f"_hit.{v}").alias(v) for v in values])
    return left.join(found, [*by, left_time], "left")
