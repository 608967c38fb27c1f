"""Materialised totals that follow their table by signed changes.

A batch adds what its new rows count and takes away what the rows they replace counted, summed per key before anything is
stored. Sums are exact (decimals), so totals do not drift however often rows are corrected. ``fold`` adds finished batches up
into one state; the cost of a batch follows the batch, that of reading the number of keys and of batches since the last fold.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from agoralake import schemas
from agoralake.sources.files import hadoop_path, read_small_text, write_small_text
from agoralake.sources.tables import VersionedTable

_LIST = "_BATCHES"
AMOUNT = T.DecimalType(38, 10)


class AdditiveView:
    """Sums of ``measures`` per ``keys``; ``rows`` is counted besides, and keys without rows leave the totals."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[T.StructField], measures: dict[str, Column]):
        self.spark, self.path, self.measures = spark, path.rstrip("/"), {"rows": F.lit(1), **measures}
        self.keys = [k.name for k in keys]
        self.schema = T.StructType([*keys, *[T.StructField(m, AMOUNT) for m in self.measures]])
        self.changes = VersionedTable(spark, f"{self.path}/changes", self.schema, self.keys)

    def _signed(self, rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(*self.keys, *[(F.coalesce(m.cast(AMOUNT), F.lit(0).cast(AMOUNT)) * sign).cast(AMOUNT).alias(name)
                                         for name, m in self.measures.items()])

    def _sums(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(m).cast(AMOUNT).alias(m) for m in self.measures])

    def _state(self) -> tuple[str | None, set[str]]:
        fs, pattern = hadoop_path(self.spark, f"{self.path}/state=*/{_LIST}")
        folders = sorted(f.getPath().getParent().toString() for f in (fs.globStatus(pattern) or []))
        if not folders:
            return None, set()
        return folders[-1], set(read_small_text(self.spark, f"{folders[-1]}/{_LIST}").split("\n"))

    def batches(self) -> set[str]:
        """Batches whose changes count, folded ones included."""
        return self._state()[1] | set(self.changes.runs())

    def apply(self, batch: str, new: DataFrame | None = None, old: DataFrame | None = None) -> bool:
        """Rows that came, and rows they replace or that went. A batch applied before is replaced, unless it has been folded:
        then nothing happens and the answer is False."""
        if batch in self._state()[1]:
            return False
        parts = [self._signed(df, sign) for df, sign in ((new, 1), (old, -1)) if df is not None]
        changes = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        self.changes.write(self._sums(changes), time.time_ns() // 1000, batch)
        return True

    def totals(self) -> DataFrame:
        folder, folded = self._state()
        rows = self.changes._rows(lambda run: run not in folded).drop("version")
        if folder:
            rows = rows.unionByName(self.spark.read.schema(self.schema).parquet(folder))
        return self._sums(rows).where(F.col("rows") != 0)

    def fold(self) -> None:
        """Add all batches up. The new state counts once its list of batches is there."""
        names = self.batches()
        folder = f"{self.path}/state={time.time_ns() // 1000:020d}"
        self.totals().write.parquet(folder)
        write_small_text(self.spark, f"{folder}/{_LIST}", "\n".join(sorted(names)))


def sentiment_view(spark: SparkSession, path: str) -> AdditiveView:
    """Posts, labels and scores per day and source, over gold rows with ``day``."""
    label = F.col("sentiment_label")
    one = lambda name: F.when(label == name, 1).otherwise(0)
    keys = [T.StructField("day", schemas.DT), T.StructField("source", schemas.S)]
    return AdditiveView(spark, path, keys, {
        "positive": one("positive"), "negative": one("negative"), "neutral": one("neutral"),
        "score_sum": F.col("sentiment_score"), "score_n": F.when(F.col("sentiment_score").isNotNull(), 1).otherwise(0)})


def with_day(gold: DataFrame) -> DataFrame:
    return gold.where(F.col("datetime_utc").isNotNull()).withColumn("day", F.to_date("datetime_utc"))


def sentiment_daily(totals: DataFrame) -> DataFrame:
    """The dashboard's view from the totals."""
    whole = lambda c, name: F.col(c).cast("bigint").alias(name)
    return totals.select("day", "source", whole("rows", "posts"), whole("positive", "positive_count"), whole("negative", "negative_count"),
                         whole("neutral", "neutral_count"),
                         F.when(F.col("score_n") > 0, F.col("score_sum").cast("double") / F.col("score_n").cast("double")).alias("avg_sentiment"))
