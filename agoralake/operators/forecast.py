"""Forecast targets, scaled history sequences, time-ordered split and evaluation metrics.

Windows without a partition here run over rows of the calendar (one per multi-day window or poll date), never over posts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from agoralake.operators.feature_table import poll_date_of_window, poll_means

# Weights of level and movement in the target, softmax temperature, history length, split shares.
LEVEL_WEIGHT, DELTA_WEIGHT = 0.85, 0.15
TEMPERATURE = 0.3
HISTORY = 4
TRAIN_SHARE, VALIDATION_SHARE = 0.70, 0.15
EPSILON = 1e-8


def carried_levels(polls: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """(fecha, candidato, nivel) for every poll date and listed candidate.

    A candidate missing from a poll keeps the previous level; before the first measurement the level is 1/n.
    """
    dates = polls.where(F.col("fecha").isNotNull()).select("fecha").distinct()
    grid = dates.select("fecha", F.explode(F.array([F.lit(c) for c in candidates])).alias("candidato"))
    known = grid.join(poll_means(polls), ["fecha", "candidato"], "left")
    so_far = Window.partitionBy("candidato").orderBy("fecha").rowsBetween(Window.unboundedPreceding, 0)
    level = F.coalesce(F.last("intencion_voto", ignorenulls=True).over(so_far), F.lit(1.0 / len(candidates)))
    return known.select("fecha", "candidato", level.alias("nivel"))


def share_of(value: Column, group: Sequence[str]) -> Column:
    """Value over the group's sum; a group that sums to 0 is left as it is."""
    total = F.sum(value).over(Window.partitionBy(*group))
    return value / F.when(total == 0, F.lit(1.0)).otherwise(total)


def softmax(value: Column, group: Sequence[str], temperature: float = TEMPERATURE) -> Column:
    powered = F.exp(value / temperature)
    return powered / F.sum(powered).over(Window.partitionBy(*group))


def movements(polls: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Normalised level, change since the previous poll (the first against 1/n) and its softmax."""
    by_time = Window.partitionBy("candidato").orderBy("fecha")
    levels = carried_levels(polls, candidates).withColumn("nivel", share_of(F.col("nivel"), ["fecha"]))
    delta = F.col("nivel") - F.coalesce(F.lag("nivel", 1).over(by_time), F.lit(1.0 / len(candidates)))
    return levels.withColumn("delta", delta).withColumn("delta_soft", softmax(F.col("delta"), ["fecha"]))


def targets(polls: DataFrame, candidates: Sequence[str], windows: DataFrame, level_weight: float = LEVEL_WEIGHT,
            delta_weight: float = DELTA_WEIGHT) -> DataFrame:
    """(ventana, candidato, nivel, objetivo): the target distribution of each window, summing to 1."""
    in_force = poll_date_of_window(windows, polls)
    rows = in_force.join(movements(polls, candidates), "fecha")
    raw = F.col("nivel") * level_weight + F.col("delta_soft") * delta_weight
    return rows.withColumn("_raw", raw).select(
        "ventana", "fecha_ini_ventana", "candidato", "nivel",
        (F.col("_raw") / F.sum("_raw").over(Window.partitionBy("ventana"))).alias("objetivo"))


def target_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("candidato").agg(
        F.avg("objetivo").alias("media"), F.min("objetivo").alias("minimo"), F.max("objetivo").alias("maximo"))


def min_max_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column scaled to 0..1 over the whole table; a constant column becomes 0."""
    bounds = df.agg(F.struct(*[F.min(c).alias(f"lo_{i}") for i, c in enumerate(columns)],
                             *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(columns)])).scalar()
    rows = df.withColumn("_b", bounds)
    scaled = {}
    for i, c in enumerate(columns):
        low, high = F.col(f"_b.lo_{i}"), F.col(f"_b.hi_{i}")
        scaled[c] = F.coalesce((F.col(c) - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))
    return rows.withColumns(scaled).drop("_b")


def sequences(features: DataFrame, columns: Sequence[str], order_by: str = "ventana",
              length: int = HISTORY) -> DataFrame:
    """For every window with enough past: the feature vectors of the ``length`` windows before it."""
    past = Window.orderBy(order_by).rowsBetween(-length, -1)
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    return (
        features.select(order_by, F.collect_list(vector).over(past).alias("historia"))
        .where(F.size("historia") == length)
    )


def last_sequence(features: DataFrame, columns: Sequence[str], length: int = HISTORY,
                  days: int = 3) -> DataFrame:
    """The newest ``length`` windows as one history, and the dates of the window it predicts."""
    newest = features.orderBy(F.col("ventana").desc()).limit(length)
    entry = F.struct(F.col("ventana"), F.array(*[F.col(c).cast("double") for c in columns]).alias("v"))
    start = F.date_add(F.max("fecha_fin_ventana"), 1)
    return newest.agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["v"]).alias("historia"),
        start.alias("fecha_ini"), F.date_add(start, days - 1).alias("fecha_fin"))


def time_split(rows: DataFrame, order_by: str = "ventana") -> DataFrame:
    """Mark rows train, validation or test in time order; shares are cut down to whole rows."""
    everything = Window.partitionBy()
    n = F.count(F.lit(1)).over(everything)
    position = F.row_number().over(Window.orderBy(order_by)) - 1
    train, validation = F.floor(n * TRAIN_SHARE), F.floor(n * VALIDATION_SHARE)
    part = (F.when(position < train, "train").when(position < train + validation, "validation").otherwise("test"))
    return rows.withColumn("parte", part)


class SequenceForecaster:
    """What a forecaster has to offer: one distribution per history. Training happens elsewhere."""

    name, version = "unknown", "0.0"

    def predict(self, histories: np.ndarray) -> np.ndarray:
        raise NotImplementedError


class PersistenceForecaster(SequenceForecaster):
    """Repeats the last values of the chosen feature positions, normalised."""

    name, version = "persistence", "1.0"

    def __init__(self, positions: Sequence[int]):
        self.positions = list(positions)

    def predict(self, histories: np.ndarray) -> np.ndarray:
        last = histories[:, -1, self.positions]
        total = last.sum(axis=1, keepdims=True)
        even = np.full_like(last, 1.0 / len(self.positions))
        return np.where(total > 0, last / np.where(total == 0, 1.0, total), even)


def forecast(rows: DataFrame, model: SequenceForecaster, candidates: Sequence[str]) -> DataFrame:
    """Apply a forecaster to ``historia``; one row per history and candidate."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if len(batch) == 0:
                yield pd.Series([], dtype=object)
                continue
            stacked = np.array([[list(step) for step in history] for history in batch], dtype="float64")
            yield pd.Series(list(model.predict(stacked)))

    names = F.array([F.lit(c) for c in candidates])
    pairs = F.explode(F.arrays_zip(names.alias("candidato"), predict("historia").alias("pred")))
    kept = [c for c in rows.columns if c != "historia"]
    return rows.select(*kept, pairs.alias("_p")).select(
        *kept, F.col("_p.candidato").alias("candidato"), F.col("_p.pred").alias("pred"))


# --- metrics over (sequence, candidato, real, pred) -------------------------------------------------------------------

def overall_metrics(rows: DataFrame, sequence: str = "ventana") -> DataFrame:
    """R2, MAE, MAPE (actual above 1 %), Brier score and KL divergence."""
    r, p = F.col("real"), F.col("pred")
    counted = r > 0.01
    per_sequence = rows.groupBy(sequence).agg(
        F.sum((r - p) * (r - p)).alias("sq"),
        F.sum(r * (F.log(r + EPSILON) - F.log(p + EPSILON))).alias("kl"),
        F.sum(F.abs(p - r)).alias("err"),
        F.sum(F.when(counted, F.abs((r - p) / r))).alias("pct"),
        F.count(F.when(counted, 1)).alias("n_pct"),
        F.count(F.lit(1)).alias("n"), F.sum(r).alias("r1"), F.sum(r * r).alias("r2"),
    )
    spread = F.sum("r2") - F.sum("r1") * F.sum("r1") / F.sum("n")
    return per_sequence.agg(
        F.when(spread > 0, 1 - F.sum("sq") / spread).alias("r2"),
        (F.sum("err") / F.sum("n")).alias("mae"),
        (F.try_divide(F.sum("pct"), F.sum("n_pct")) * 100).alias("mape"),
        F.avg("sq").alias("brier"),
        F.avg("kl").alias("kl"),
    )


def candidate_metrics(rows: DataFrame) -> DataFrame:
    """MAE in points, MAPE and R2 per candidate; R2 is NULL without variance."""
    r, p = F.col("real"), F.col("pred")
    counted = r > 0.01
    spread = F.var_pop(r) * F.count(r)
    return rows.groupBy("candidato").agg(
        (F.avg(F.abs(p - r)) * 100).alias("mae_puntos"),
        (F.avg(F.when(counted, F.abs((r - p) / r))) * 100).alias("mape"),
        F.when(spread > 1e-6, 1 - F.sum((r - p) * (r - p)) / spread).alias("r2"),
    )


def mean_pred_and_real(rows: DataFrame) -> DataFrame:
    return rows.groupBy("candidato").agg(F.avg("pred").alias("pred_media"), F.avg("real").alias("real_media"))


def with_level_change(levels: DataFrame) -> DataFrame:
    """Change of the level since the previous window; 0 for the first."""
    by_time = Window.partitionBy("candidato").orderBy("ventana")
    return levels.withColumn("cambio", F.coalesce(F.col("nivel") - F.lag("nivel", 1).over(by_time), F.lit(0.0)))


def direction_accuracy(rows: DataFrame, n_candidates: int) -> DataFrame:
    """Share of windows, in percent, in which "above 1/n" agrees with a rising level. Needs ``pred, cambio``."""
    agrees = (F.col("pred") > 1.0 / n_candidates) == (F.col("cambio") > 0)
    return rows.groupBy("candidato").agg(
        (F.avg(agrees.cast("double")) * 100).alias("acierto"),
        (F.avg((F.col("cambio") > 0).cast("double")) > 0.5).alias("sube"))


def ranked_predictions(rows: DataFrame, n_candidates: int) -> DataFrame:
    """Predictions with an up or down mark against 1/n, highest first."""
    direction = F.when(F.col("pred") > 1.0 / n_candidates, "SUBE").otherwise("BAJA")
    return rows.withColumn("direccion", direction).orderBy(F.col("pred").desc(), "candidato")
