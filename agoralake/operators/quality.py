"""The blocking quality gate: five checks over one run's silver posts, all in one aggregation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agoralake import schemas
from agoralake.functions import pii
from agoralake.functions.scoring import percent_deviation

# Fields that must be present, and the thresholds of the checks.
REQUIRED_FIELDS = ["id", "source", "text_clean", "datetime_utc"]
COMPLETE_PASS, COMPLETE_WARN = 95.0, 90.0
MAX_AGE_DAYS = 30
STALE_PASS, STALE_WARN = 20.0, 50.0
VOLUME_TOLERANCE, VOLUME_MINIMUM = 70.0, 10
BASELINE_RUNS = 7
SEVERITY = {"PASS": 0, "WARN": 1, "FAIL": 2}


def is_empty(name: str) -> Column:
    c = F.col(name)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def schema_rules(columns: Sequence[str]) -> dict[str, Column]:
    """Rule name -> violated? for the silver contract, limited to the columns at hand."""
    needed = ["id", "source", "source_id", "text_original", "text_clean", "engagement", "metadata", "pii_detected",
              "pii_types", "is_duplicate", "cleaned_at"]
    rules = {f"{c}_missing": F.col(c).isNull() for c in needed if c in columns}
    rules["source_unknown"] = ~F.coalesce(F.col("source").isin(schemas.SOURCES), F.lit(False))
    return rules


def failed_rules(columns: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in schema_rules(columns).items()]))


def split_valid(df: DataFrame, columns: Sequence[str] | None = None,
                store: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and those that do not with the names of the broken rules.

    ``columns`` are those the halves are to have, by default all; the rules look at all. ``store`` writes the marked rows, for
    callers that read both halves: else each half computes ``df`` anew.
    """
    marked = df.withColumn("_errors", failed_rules(df.columns))
    marked = store(marked if columns is None else marked.select(*columns, "_errors"))
    good = marked.where(F.size("_errors") == 0).drop("_errors")
    bad = marked.where(F.size("_errors") > 0).withColumn("error", F.array_join("_errors", ", ")).drop("_errors")
    return good, bad


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def measures(posts: DataFrame, as_of: Column, by: Sequence[str] = (),
             required: Sequence[str] = REQUIRED_FIELDS, max_age_days: int = MAX_AGE_DAYS) -> DataFrame:
    """Every number the five checks need, in one pass; one row, or one per group of ``by``."""
    at = F.col("datetime_utc")
    oldest = as_of - F.make_dt_interval(F.lit(max_age_days))
    text_leak = F.col("pii_detected") & pii.exposes_pii(F.col("text_original"))
    any_empty = is_empty(required[0])
    for name in required[1:]:
        any_empty = any_empty | is_empty(name)
    return posts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        _count(~any_empty).alias("complete"),
        *[_count(is_empty(f)).alias(f"empty_{f}") for f in required],
        _count(at > as_of).alias("future"),
        _count(at < oldest).alias("stale"),
        _count(at.isNull()).alias("unparseable"),
        _count(F.size(failed_rules(posts.columns)) > 0).alias("invalid"),
        _count(text_leak).alias("leaked_text"),
        _count(pii.has_any_key(F.col("metadata"))).alias("leaked_metadata"),
    )


def baseline(runs: DataFrame, exclude_run: str | None = None, n: int = BASELINE_RUNS) -> DataFrame:
    """Mean and number of the row counts of the last ``n`` successes. Zero counts are dropped after the cut."""
    past = runs.where(F.col("status") == "success")
    if exclude_run is not None:
        past = past.where(F.col("run_id") != exclude_run)
    last = past.orderBy(F.col("started_at").desc(), F.col("run_id")).limit(n)
    kept = last.where(F.col("rows_out") > 0)
    return kept.agg(F.avg("rows_out").alias("baseline_avg"), F.count("rows_out").alias("baseline_runs"))


# --- verdicts over the measures ---------------------------------------------------------------------------------------

def percent(part: str, total: str = "total") -> Column:
    return F.try_divide(F.col(part) * 100.0, F.col(total))


def completeness_status() -> Column:
    share = percent("complete")
    return F.when(share >= COMPLETE_PASS, "PASS").when(share >= COMPLETE_WARN, "WARN").otherwise("FAIL")


def freshness_status() -> Column:
    stale = percent("stale")
    return (F.when(F.col("total") == 0, "FAIL").when(F.col("future") > 0, "FAIL").when(stale > STALE_WARN, "FAIL")
            .when(stale > STALE_PASS, "WARN").otherwise("PASS"))


def volume_status(total: Column, avg: Column, n: Column) -> Column:
    off = percent_deviation(total, avg)
    return (F.when(total < VOLUME_MINIMUM, "FAIL").when(F.coalesce(n, F.lit(0)) < 2, "PASS")
            .when(off <= VOLUME_TOLERANCE, "PASS").when(off <= 2 * VOLUME_TOLERANCE, "WARN").otherwise("FAIL"))


def schema_status() -> Column:
    return F.when((F.col("total") > 0) & (F.col("invalid") == 0), "PASS").otherwise("FAIL")


def leak_status() -> Column:
    return F.when((F.col("total") > 0) & (F.col("leaked_text") + F.col("leaked_metadata") == 0), "PASS").otherwise("FAIL")


def overall_status(*statuses: Column) -> Column:
    worst = F.lit(0)
    for s in statuses:
        worst = F.greatest(worst, F.when(s == "FAIL", 2).when(s == "WARN", 1).otherwise(0))
    return F.when(worst == 2, "FAIL").when(worst == 1, "WARN").otherwise("PASS")


def with_statuses(measured: DataFrame, baseline_avg: Column, baseline_runs: Column) -> DataFrame:
    """Add the status of each check and ``overall``."""
    rows = measured.withColumn("baseline_avg", baseline_avg).withColumn("baseline_runs", baseline_runs)
    rows = rows.withColumns({
        "completeness": completeness_status(),
        "freshness": freshness_status(),
        "volume": volume_status(F.col("total"), F.col("baseline_avg"), F.col("baseline_runs")),
        "schema": schema_status(),
        "pii_leak": leak_status(),
    })
    return rows.withColumn("overall", overall_status(
        *[F.col(c) for c in ("completeness", "freshness", "volume", "schema", "pii_leak")]))


def _detail(*names: str) -> Column:
    return F.map_from_arrays(F.array([F.lit(n) for n in names]), F.array([F.col(n).cast("string") for n in names]))


def report(posts: DataFrame, runs: DataFrame, run_id: str, layer: str, as_of: Column,
           created_at: Column | None = None) -> DataFrame:
    """One report row for a run. A run without rows fails."""
    prior = baseline(runs, run_id)
    rows = with_statuses(measures(posts, as_of), prior.select("baseline_avg").scalar(),
                         prior.select("baseline_runs").scalar())
    none = F.col("total") == 0

    def check(name: str, reason: Column, *detail: str) -> Column:
        return F.struct(F.lit(name).alias("check"), F.col(name).alias("status"), reason.cast("string").alias("reason"),
                        _detail(*detail).alias("detail"))

    stale = percent("stale")
    late = (F.when(none, "no_records")
            .when(F.col("future") > 0, F.concat(F.col("future").cast("string"), F.lit("_future_dates")))
            .when(stale > STALE_PASS, F.concat(F.lit("stale_pct="), F.format_number(stale, 1))))
    few = (F.when(F.col("total") < VOLUME_MINIMUM, f"below_min_absolute({VOLUME_MINIMUM})")
           .when(F.coalesce(F.col("baseline_runs"), F.lit(0)) < 2, "no_baseline_yet"))
    empty = F.when(none, "no_records")
    checks = F.array(
        check("completeness", F.when(none, "silver_empty_for_run"), "complete", *[f"empty_{f}" for f in REQUIRED_FIELDS]),
        check("freshness", late, "stale", "future", "unparseable"),
        check("volume", few, "total", "baseline_avg", "baseline_runs"),
        check("schema", empty, "invalid"),
        check("pii_leak", empty, "leaked_text", "leaked_metadata"),
    )
    return rows.select(
        F.lit(run_id).alias("run_id"), F.lit(layer).alias("layer"), "overall", F.col("total").alias("total_records"),
        checks.alias("checks"), (F.current_timestamp() if created_at is None else created_at).alias("created_at"))


def summary(reports: DataFrame) -> DataFrame:
    """Compact map check -> status per report."""
    pairs = F.transform("checks", lambda c: F.struct(c["check"], c["status"]))
    return reports.select("run_id", "layer", "overall", "total_records", F.map_from_entries(pairs).alias("checks"))


def alerts(reports: DataFrame, channel: str = "slack") -> DataFrame:
    """One alert row per report that is not PASS."""
    level = F.when(F.col("overall") == "FAIL", "CRITICAL").otherwise("WARNING")
    return reports.where(F.col("overall") != "PASS").select(
        "run_id", level.alias("severity"), F.lit(channel).alias("channel"),
        F.to_json(F.struct("layer", "overall")).alias("payload"), F.lit(False).alias("delivered"), "created_at")


def violations(posts: DataFrame, n: int | None = None) -> DataFrame:
    """What failed, lowest ids first; ``n`` asks for examples only."""
    leak = F.when(F.col("pii_detected") & pii.exposes_pii(F.col("text_original")), F.concat(F.lit("text_leak:"), "id"))
    keys = F.when(pii.has_any_key(F.col("metadata")), F.concat(F.lit("meta_leak:"), "id"))
    rules = F.when(F.size(failed_rules(posts.columns)) > 0, F.concat(F.lit("schema:"), F.coalesce("id", F.lit("?"))))
    found = posts.select(F.explode(F.array_compact(F.array(leak, keys, rules))).alias("violation"))
    return found.orderBy("violation") if n is None else found.orderBy("violation").limit(n)
