"""Dashboard views over gold features, the run ledger and quality reports. Time-relative views take ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from agoralake.functions.timefn import run_seconds
from agoralake.operators.dedupe import dedupe

# Rows a dashboard page shows, and the span of the volume view. A page size is for a caller to ask for.
HEALTH_PAGE, RUNS_PAGE, REPORTS_PAGE, VOLUME_DAYS = 50, 200, 50, 7


def page(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def hours_before(as_of: Column, hours: int) -> Column:
    return as_of - F.make_dt_interval(hours=F.lit(hours))


def sentiment_daily(gold: DataFrame) -> DataFrame:
    label = F.col("sentiment_label")
    return gold.where(F.col("datetime_utc").isNotNull()).groupBy(F.to_date("datetime_utc").alias("day"), "source").agg(
        F.count(F.lit(1)).alias("posts"),
        F.count_if(label == "positive").alias("positive_count"),
        F.count_if(label == "negative").alias("negative_count"),
        F.count_if(label == "neutral").alias("neutral_count"),
        F.avg("sentiment_score").alias("avg_sentiment"))


def sources_volume(gold: DataFrame, as_of: Column, days: int = VOLUME_DAYS) -> DataFrame:
    recent = gold.where(F.col("datetime_utc") >= hours_before(as_of, 24 * days))
    return (recent.groupBy("source", F.to_date("datetime_utc").alias("day")).agg(F.count(F.lit(1)).alias("posts"))
            .orderBy(F.col("day").desc(), "source"))


def sources_volume_brief(gold: DataFrame, as_of: Column) -> DataFrame:
    return sources_volume(gold, as_of).select("source", "posts")


def pipeline_health(runs: DataFrame, limit: int | None = None) -> DataFrame:
    return page(runs.orderBy(F.col("started_at").desc(), F.col("run_id")), limit).withColumn(
        "duration_seconds", run_seconds(F.col("started_at"), F.col("finished_at")))


def last_success_by_flow(runs: DataFrame) -> DataFrame:
    """The newest success per flow; only one row per flow and task is shuffled."""
    window = Window.partitionBy("flow_name").orderBy(F.col("started_at").desc(), F.col("run_id"))
    done = runs.where(F.col("status") == "success").withColumn("_rn", F.row_number().over(window))
    return done.where(F.col("_rn") == 1).select("flow_name", "run_id", "started_at", "finished_at", "rows_out")


def quality_failed_rate(runs: DataFrame, as_of: Column) -> DataFrame:
    """Share of gate failures among all runs of the last 24 hours and 7 days."""
    recent = F.unix_micros("started_at") >= F.unix_micros(as_of) - F.lit(168 * 3_600_000_000)
    none = runs.sparkSession.range(1).select(*[F.lit(None).cast(runs.schema[c].dataType).alias(c) for c in ("run_id", "status", "started_at")])
    newest = runs.select("run_id", "status", "started_at").where(recent).unionByName(none)  # so both spans have a row
    spans = F.explode(F.array(
        F.struct(F.lit("24h").alias("window"), F.lit(24).alias("hours")),
        F.struct(F.lit("7d").alias("window"), F.lit(168).alias("hours")))).alias("_s")
    inside = F.unix_micros("started_at") >= F.unix_micros(as_of) - F.col("_s.hours") * F.lit(3_600_000_000)
    failed = F.count_if(inside & (F.col("status") == "quality_failed"))
    total = F.count_if(inside)
    return newest.select("*", spans).groupBy(F.col("_s.window").alias("window")).agg(
        total.alias("total_runs"), failed.alias("quality_failed"),
        F.coalesce(F.round(F.try_divide(failed, total), 4), F.lit(0.0)).alias("failure_rate"))


def metrics_summary(gold: DataFrame, runs: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    return {
        "sources_volume_7d": sources_volume_brief(gold, as_of),
        "last_success_by_flow": last_success_by_flow(runs),
        "sentiment_daily": sentiment_daily(gold).drop("day"),
        "quality_failed_rate": quality_failed_rate(runs, as_of),
    }


def list_runs(runs: DataFrame, status: str | None = None, flow_name: str | None = None, hours: int | None = None,
              as_of: Column | None = None, limit: int | None = None) -> DataFrame:
    """Runs, newest first."""
    if status:
        runs = runs.where(F.col("status") == status)
    if flow_name:
        runs = runs.where(F.col("flow_name") == flow_name)
    if hours:
        runs = runs.where(F.col("started_at") >= hours_before(F.current_timestamp() if as_of is None else as_of, hours))
    return page(runs.orderBy(F.col("started_at").desc(), F.col("run_id")), limit)


def run_by_id(runs: DataFrame, run_id) -> DataFrame:
    return runs.where(F.col("run_id") == run_id)


def list_reports(reports: DataFrame, run_id=None, layer: str | None = None, overall: str | None = None,
                 limit: int | None = None) -> DataFrame:
    for name, value in (("run_id", run_id), ("layer", layer), ("overall", overall)):
        if value is not None:
            reports = reports.where(F.col(name) == value)
    newest = reports.orderBy(F.col("created_at").desc(), F.col("run_id"), F.col("layer"))
    return page(newest, limit)


def reports_for_run(reports: DataFrame, run_id) -> DataFrame:
    return reports.where(F.col("run_id") == run_id).orderBy("layer")


def layer_counts(raw: DataFrame, silver: DataFrame, gold: DataFrame, run_id) -> DataFrame:
    """Row counts of a run in each layer."""
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.where(F.col("run_id") == run_id).agg(F.count(F.lit(1)).alias("filas")).select(
            F.lit(name).alias("capa"), "filas")
    return one("raw", raw).unionByName(one("silver", silver)).unionByName(one("gold", gold))


def in_latest_run(rows: DataFrame, runs: DataFrame, flow_name: str | None = None) -> DataFrame:
    """Rows written by the newest successful run."""
    done = runs.where(F.col("status") == "success")
    if flow_name:
        done = done.where(F.col("flow_name") == flow_name)
    newest = done.orderBy(F.col("started_at").desc(), F.col("run_id")).limit(1).select("run_id")
    return rows.join(newest, "run_id", "left_semi")


def replies_with_parents(posts: DataFrame) -> DataFrame:
    """Each post next to its parent; roots and orphans have no parent."""
    parent = posts.select(F.col("id").alias("parent_id"), F.col("text").alias("parent_text"))
    roots = posts.where(F.col("parent_id").isNull()).withColumn("parent_text", F.lit(None).cast("string"))
    # Roots have nothing to join; keeping them out stops their NULL keys from meeting in one task.
    return posts.where(F.col("parent_id").isNotNull()).join(parent, "parent_id", "left").select(
        *posts.columns, "parent_text").unionByName(roots)


def roots_and_replies(posts: DataFrame, by: str) -> DataFrame:
    return posts.groupBy(by).agg(F.count_if(F.col("parent_id").isNull()).alias("comentarios"),
                                 F.count_if(F.col("parent_id").isNotNull()).alias("respuestas"))


def register(gold: DataFrame, runs: DataFrame, as_of: Column) -> None:
    """Temp views under the names dashboards use."""
    sentiment_daily(gold).createOrReplaceTempView("v_sentiment_daily")
    pipeline_health(runs).createOrReplaceTempView("v_pipeline_health")
    sources_volume(gold, as_of).createOrReplaceTempView("v_sources_volume_7d")
    last_success_by_flow(runs).createOrReplaceTempView("v_last_success_by_flow")
