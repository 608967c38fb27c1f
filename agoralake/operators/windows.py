"""Fixed-origin windows and the weighted score per entity, network and window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from agoralake.functions import scoring, timefn


def with_windows(df: DataFrame, time: str, origin: Column, days: int = timefn.WINDOW_DAYS) -> DataFrame:
    """Add ``ventana, fecha_ini_ventana, fecha_fin_ventana``."""
    day = F.to_date(time)
    return (
        df.withColumn("_origin", origin)
        .withColumn("ventana", timefn.window_index(day, F.col("_origin"), days))
        .withColumn("fecha_ini_ventana", timefn.window_start(F.col("ventana"), F.col("_origin"), days))
        .withColumn("fecha_fin_ventana", timefn.window_end(F.col("ventana"), F.col("_origin"), days))
        .drop("_origin")
    )


def first_day(df: DataFrame, time: str) -> Column:
    """The earliest day as a scalar subquery: one small value, planned with the query that uses it."""
    return df.agg(F.min(F.to_date(time))).scalar()


def windowed_scores(posts: DataFrame, entities: str, origin: Column | None = None, time: str = "fecha",
                    days: int = timefn.WINDOW_DAYS, intention: str | None = "intencion_explicita",
                    store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Weighted mean score, plain mean, mentions and engagement per entity, network and window.

    Posts without a date or an entity take no part. The origin defaults to the first day among the posts that do; pass
    one to skip that scan. Where ``posts`` are joined or otherwise costly to compute for that scan and again for the scores,
    ``store`` writes what both read of them. Sums are combined map-side, so a dominant entity sends one row per task.
    """
    dated = posts.where(F.col(time).isNotNull() & (F.size(entities) > 0))
    if origin is None and store is not None:
        used = [time, entities, "red", "score", "engagement", *([intention] if intention else [])]
        dated = store(dated.select(*dict.fromkeys(used)))
    start = first_day(dated, time) if origin is None else origin
    bonus = F.col(intention) if intention else F.lit(0)
    rows = with_windows(dated, time, start, days).select(
        F.explode(entities).alias("entidad"), "red", "ventana", "fecha_ini_ventana", "fecha_fin_ventana",
        scoring.composite_score(F.col("score"), bonus).alias("_score"),
        F.coalesce(F.col("engagement"), F.lit(0.0)).alias("_eng"),
    )
    weight = scoring.log_weight(F.col("_eng"))
    return (
        rows.groupBy("entidad", "red", "ventana", "fecha_ini_ventana", "fecha_fin_ventana")
        .agg(
            (F.sum(F.col("_score") * weight) / F.sum(weight)).alias("score_final"),
            F.avg("_score").alias("score_promedio"),
            F.count(F.lit(1)).alias("menciones"),
            F.sum("_eng").alias("engagement_total"),
        )
    )


def period_scores(posts: DataFrame, entities: str, first: str, last: str, time: str = "fecha", **kw) -> DataFrame:
    """The same over one event period, both bounds included (times, so the last day counts up to midnight)."""
    inside = posts.where(F.col(time).between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")))
    return windowed_scores(inside, entities, time=time, **kw)


def window_list(scores: DataFrame) -> DataFrame:
    return scores.select("ventana", "fecha_ini_ventana", "fecha_fin_ventana").distinct().orderBy("ventana")


def ranking(scores: DataFrame) -> DataFrame:
    """Entities by mean window score. Ranks are taken over one row per entity."""
    per_entity = scores.groupBy("entidad").agg(
        F.avg("score_final").alias("score_promedio"), F.sum("menciones").alias("menciones_total"))
    order = Window.orderBy(F.col("score_promedio").desc(), F.col("entidad"))
    return per_entity.withColumn("posicion", F.row_number().over(order))


def entity_counts(posts: DataFrame, entities: str, name: str = "entidad") -> DataFrame:
    return posts.select(F.explode(entities).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("menciones"))


def top_entities(posts: DataFrame, entities: str, k: int, name: str = "entidad") -> DataFrame:
    return entity_counts(posts, entities, name).orderBy(F.col("menciones").desc(), name).limit(k)


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("registros"))


def date_spans(df: DataFrame, by: Sequence[str], time: str = "fecha") -> DataFrame:
    return df.where(F.col(time).isNotNull()).groupBy(*by).agg(
        F.min(time).alias("min_fecha"), F.max(time).alias("max_fecha"), F.count(time).alias("registros"))
