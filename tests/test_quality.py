import datetime as dt

import pytest
from pyspark.sql import functions as F

from agoralake import schemas
from agoralake.operators import quality
from agoralake.plans import views
from agoralake.queries import QUERIES

NOW = dt.datetime(2026, 5, 20)


def silver(spark, n=100, undated=0, stale=0, future=0, **change):
    rows = []
    for i in range(n):
        at = None if i < undated else NOW - dt.timedelta(days=40) if i < undated + stale else (
            NOW + dt.timedelta(days=1) if i < undated + stale + future else NOW - dt.timedelta(days=1))
        row = {f.name: None for f in schemas.SILVER_POST.fields}
        row.update(id=f"p{i}", source="twitter", source_id=str(i), datetime_utc=at, text_clean="hola", text_original="hola",
                   engagement={}, metadata={}, pii_detected=True, pii_types=[], is_duplicate=False, cleaned_at=NOW, run_id="r")
        if i == n - 1:
            row.update(change)
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, schemas.SILVER_POST)


def runs(spark, *volumes, status="success"):
    rows = [(f"run{i}", "e2e", status, NOW - dt.timedelta(hours=i), NOW, None, v, None, None) for i, v in enumerate(volumes)]
    return spark.createDataFrame(rows, schemas.RUN)


def statuses(spark, posts, history=()):
    as_of = F.lit("2026-05-20 00:00:00").cast("timestamp")
    row = quality.report(posts, runs(spark, *history), "r", "silver", as_of)
    checks = {c["check"]: c["status"] for c in row.first()["checks"]}
    return checks, row.first()["overall"]


@pytest.mark.parametrize("undated, expected", [(0, "PASS"), (5, "PASS"), (6, "WARN"), (10, "WARN"), (11, "FAIL")])
def test_completeness_edges(spark, undated, expected):
    assert statuses(spark, silver(spark, undated=undated))[0]["completeness"] == expected


@pytest.mark.parametrize("stale, future, expected", [(20, 0, "PASS"), (21, 0, "WARN"), (50, 0, "WARN"), (51, 0, "FAIL"), (0, 1, "FAIL")])
def test_freshness_edges(spark, stale, future, expected):
    assert statuses(spark, silver(spark, stale=stale, future=future))[0]["freshness"] == expected


@pytest.mark.parametrize("n, history, expected", [
    (9, (), "FAIL"), (10, (), "PASS"), (100, (10,), "PASS"), (100, (0, 10), "PASS"), (17, (10, 10), "PASS"), (24, (10, 10), "WARN"),
    (25, (10, 10), "FAIL"), (20, (0, 0, 0, 0, 0, 0, 10, 500, 500), "PASS"),
])
def test_volume_edges(spark, n, history, expected):
    # zero volumes are dropped after the newest seven are taken, so the last case has one baseline run
    assert statuses(spark, silver(spark, n), history)[0]["volume"] == expected


def test_schema_and_leaks(spark):
    assert statuses(spark, silver(spark, source_id=None))[0]["schema"] == "FAIL"
    assert statuses(spark, silver(spark, text_original="mi correo a@b.co"))[0]["pii_leak"] == "FAIL"
    assert statuses(spark, silver(spark, metadata={"Author": "x"}))[0]["pii_leak"] == "FAIL"
    assert statuses(spark, silver(spark, text_original="300 123 4567", pii_detected=False))[0]["pii_leak"] == "PASS"
    checks, overall = statuses(spark, silver(spark))
    assert set(checks.values()) == {"PASS"} and overall == "PASS"


def test_empty_run_fails(spark):
    checks, overall = statuses(spark, silver(spark, 1).where("false"))
    assert overall == "FAIL" and checks["completeness"] == "FAIL"


def test_alerts_and_violations(spark):
    bad = silver(spark, metadata={"handle": "x"}, text_original="a@b.co")
    as_of = F.lit("2026-05-20 00:00:00").cast("timestamp")
    row = quality.report(bad, runs(spark), "r", "silver", as_of)
    assert [(a["severity"], a["delivered"]) for a in quality.alerts(row).collect()] == [("CRITICAL", False)]
    assert [v["violation"] for v in quality.violations(bad).collect()] == ["meta_leak:p99", "text_leak:p99"]


def test_views_on_few_runs(spark):
    rows = runs(spark, 5, None, 7).unionByName(runs(spark, 1, status="quality_failed"))
    as_of = F.lit("2026-05-20 00:00:00").cast("timestamp")
    rate = {r["window"]: (r["total_runs"], r["quality_failed"], r["failure_rate"]) for r in views.quality_failed_rate(rows, as_of).collect()}
    assert rate == {"24h": (4, 1, 0.25), "7d": (4, 1, 0.25)}
    assert views.last_success_by_flow(rows).first()["run_id"] == "run0"
    assert views.list_runs(rows).count() == 4 and views.list_runs(rows, status="failed").count() == 0
    nothing = views.quality_failed_rate(rows.where("false"), as_of).collect()
    assert all(r["failure_rate"] == 0.0 for r in nothing)


def test_failure_rate_counts_every_run_of_the_span(spark):
    start = "2026-05-19 12:00:00"
    rows = spark.range(1200).select(
        F.col("id").cast("string").alias("run_id"), F.when(F.col("id") % 4 == 0, "quality_failed").otherwise("success").alias("status"),
        (F.lit(start).cast("timestamp") - F.make_dt_interval(mins=F.col("id").cast("int"))).alias("started_at"))
    got = {r["window"]: (r["total_runs"], r["quality_failed"]) for r in views.quality_failed_rate(rows, F.lit("2026-05-20 00:00:00").cast("timestamp")).collect()}
    assert got == {"24h": (721, 181), "7d": (1200, 300)}


def test_split_of_odd_posts_reads_them_once(spark, tmp_path):
    """Both halves come from marked rows stored once: a text in null, empty, repeated and overlong form, and a repeated row."""
    texts = [(0, "hola"), (0, "hola"), (1, "x " * 3500), (2, None), (3, "hola"), (4, ""), (5, None), (6, "y " * 3500), (8, "z " * 3500)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").selectExpr("*", "'es' as lang", "cast(null as string) as source")
    events = spark.createDataFrame([], "event_id bigint, ts timestamp, user_id bigint, event_type string")
    for name, found in ("whole", {("twitter", 1, 0), ("youtube", 0, 2), ("tiktok", 0, 1), ("other", 1, 0)}), ("empty", set()):
        docs.where(F.lit(name == "whole")).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        events.write.parquet(f"{tmp_path}/{name}/events.parquet")
        out = QUERIES["valid_and_quarantined"](spark, f"{tmp_path}/{name}")
        assert {tuple(r) for r in out.collect()} == found
        assert not any("documents" in f for f in out.inputFiles())


def test_split_of_chosen_columns(spark):
    posts = silver(spark, 3, source_id=None, source="nobody")
    marked = []
    good, bad = quality.split_valid(posts, ["id"], lambda df: marked.append(df) or df)
    assert [df.columns for df in marked] == [["id", "_errors"]]
    assert (good.columns, bad.columns) == (["id"], ["id", "error"])
    whole = quality.split_valid(posts)
    assert good.collect() == whole[0].select("id").collect()
    assert [tuple(r) for r in bad.collect()] == [tuple(r) for r in whole[1].select("id", "error").collect()] == [
        ("p2", "source_id_missing, source_unknown")]
