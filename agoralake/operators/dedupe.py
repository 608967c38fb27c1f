"""One row per key, with an explicit rule for which row stays."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def _ordered(order_by: Sequence[str], keep: str) -> list[Column]:
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    return [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order_by]


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str = "last",
           keep_null_keys: bool = False) -> DataFrame:
    """Keep the first or last row of each key.

    ``row_number() = 1`` makes Catalyst put a WindowGroupLimit before the shuffle, so every map task sends at most one
    row per key: a key that holds a third of the table costs no more than any other. With ``keep_null_keys`` rows
    without a key are all kept and never enter the shuffle.
    """
    rows = df
    unkeyed = None
    if keep_null_keys:
        missing = reduce(lambda a, b: a | b, [F.coalesce(F.col(k).cast("string"), F.lit("")) == "" for k in keys])
        unkeyed, rows = df.where(missing), df.where(~missing)
    window = Window.partitionBy(*keys).orderBy(*_ordered(order_by, keep))
    one = rows.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")
    return one if unkeyed is None else one.unionByName(unkeyed)


def dedupe_few(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str = "last", *,
               store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """As ``dedupe``, for wide rows of which few share a key. ``df`` must give the same rows each time.

    Keys that occur more than once are counted without the other columns and written by ``store``, so their number is known
    when the rows are joined with them: while they are few, rows of all other keys stay where they are.
    """
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    several = store(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select(
        *[F.col(k).alias(name) for k, name in names.items()]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(name)) for k, name in names.items()])
    return df.join(several, same, "left_anti").unionByName(dedupe(df.join(several, same, "left_semi"), keys, order_by, keep))


def losers(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str = "first") -> DataFrame:
    """The rows ``dedupe`` drops. Winners are matched on key *and* order columns, which spreads a hot key's copies."""
    columns = [*keys, *order_by]
    winners = dedupe(df.select(*columns), keys, order_by, keep)
    return df.join(winners, columns, "left_anti")


def unseen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``seen``, a table that may be far larger than ``df``.

    ``seen`` is first reduced to the keys at hand. For that semi join the batch's keys are the build side, so a batch
    small enough to broadcast leaves the large table where it is; the anti join then has two small sides.
    """
    known = seen.select(*keys).join(df.select(*keys), list(keys), "left_semi")
    return df.join(known, list(keys), "left_anti")


def first_n_per_group(df: DataFrame, group: Sequence[str], order_by: Sequence[Column], n: int) -> DataFrame:
    """At most ``n`` rows per group, the limit applied before the shuffle as in ``dedupe``."""
    window = Window.partitionBy(*group).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def union_by_priority(frames: Sequence[DataFrame], keys: Sequence[str], order_by: Sequence[str],
                      one_of: Callable[..., DataFrame] = dedupe) -> DataFrame:
    """Union in which the earlier frame wins on equal keys; ``one_of`` is ``dedupe`` or does the same."""
    tagged = [df.withColumn("_rank", F.lit(i)) for i, df in enumerate(frames)]
    together = reduce(lambda a, b: a.unionByName(b), tagged)
    return one_of(together, keys, ["_rank", *order_by], keep="first").drop("_rank")


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
