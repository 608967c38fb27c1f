"""Queries over the quality gate, the run ledger, reports and dashboard views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agoralake.operators import quality
from agoralake.plans import ledger, scorers, views
from agoralake.queries.layers import V_SILVER, gold_posts, silver_posts
from agoralake.queries.registry import V_POSTS, V_RUNS, Tables, as_of, ctes, query, scale, shown
from agoralake.queries.text import EMAIL, NEGATIVE, PHONE, POSITIVE, lexicon_sql
from agoralake.session import stored
from agoralake.sources import files

# --- quality gate -----------------------------------------------------------------------------------------------------

# Silver posts with faults: undated, dateless, unmasked and untagged rows, and a moment from which some are in the future.
GATE_TIME = "2024-01-25 00:00:00"
V_FAULTY = """faulty as (select id, source, case when lang = 'unknown' and length(text_clean) > 2000 then null else datetime_utc
      end as datetime_utc, case when length(text_clean) < 200 then ' ' else text_clean end as text_clean,
    case when source = 'twitter' then raw else text_original end as text_original, pii_detected,
    source = 'youtube' as names_left, case when length(text_clean) > 6000 then null else source_id end as source_id
  from silver join (select seq, text as raw from posts) using (seq))"""


def faulty_posts(t: Tables) -> DataFrame:
    """The same faults as in the oracle's view."""
    first = t.posts().select(F.col("content_id").alias("id"), "seq", F.col("text").alias("raw"))
    from agoralake.operators.dedupe import dedupe
    rows = silver_posts(t).join(dedupe(first, ["id"], ["seq"], keep="first").select("id", "raw"), "id")
    size = F.length("text_clean")
    return rows.withColumns({
        "datetime_utc": F.when(~((F.col("lang") == "unknown") & (size > 2000)), F.col("datetime_utc")),
        "text_clean": F.when(size < 200, " ").otherwise(F.col("text_clean")),
        "text_original": F.when(F.col("source") == "twitter", F.col("raw")).otherwise(F.col("text_original")),
        "metadata": F.when(F.col("source") == "youtube", F.map_concat(
            "metadata", F.create_map(F.lit("User_Name"), F.lit("x")))).otherwise(F.col("metadata")),
        "source_id": F.when(size <= 6000, F.col("source_id")),
    }).drop("raw")


V_MEASURES = f"""m as (select source, count(*) as total,
    count(*) filter (where trim(text_clean) <> '' and datetime_utc is not null) as complete,
    count(*) filter (where trim(text_clean) = '') as empty_text_clean,
    count(*) filter (where datetime_utc is null) as empty_datetime_utc,
    count(*) filter (where datetime_utc > timestamp '{GATE_TIME}') as future,
    count(*) filter (where datetime_utc < timestamp '{GATE_TIME}' - interval 20 day) as stale,
    count(*) filter (where datetime_utc is null) as unparseable,
    count(*) filter (where source_id is null) as invalid,
    count(*) filter (where pii_detected and (regexp_matches(text_original, '{EMAIL}')
      or regexp_matches(text_original, '{PHONE}'))) as leaked_text,
    count(*) filter (where names_left) as leaked_metadata
  from faulty group by 1)"""
_V_GATE = ",\n".join([V_POSTS, V_SILVER, V_FAULTY, V_MEASURES])


def measured(t: Tables) -> DataFrame:
    return quality.measures(faulty_posts(t), F.lit(GATE_TIME).cast("timestamp"), by=["source"], max_age_days=20)


@query(ctes(_V_GATE) + """select source, total, complete, empty_text_clean, empty_datetime_utc,
  round(complete * 100.0::double / total, 4) as porcentaje, case when complete * 100.0::double / total >= 95 then 'PASS'
  when complete * 100.0::double / total >= 90 then 'WARN' else 'FAIL' end as estado from m""")
def completeness_check(t: Tables) -> DataFrame:
    return scale(measured(t).select(
        "source", "total", "complete", "empty_text_clean", "empty_datetime_utc",
        quality.percent("complete").alias("porcentaje"), quality.completeness_status().alias("estado")), 4)


@query(ctes(_V_GATE) + """select source, future, stale, unparseable, case when future > 0 then 'FAIL'
  when stale * 100.0::double / total > 50 then 'FAIL' when stale * 100.0::double / total > 20 then 'WARN' else 'PASS' end as estado
  from m""")
def freshness_check(t: Tables) -> DataFrame:
    return measured(t).select("source", "future", "stale", "unparseable", quality.freshness_status().alias("estado"))


@query(ctes(_V_GATE) + "select source, invalid, case when invalid = 0 then 'PASS' else 'FAIL' end as estado from m")
def schema_check(t: Tables) -> DataFrame:
    return measured(t).select("source", "invalid", quality.schema_status().alias("estado"))


@query(ctes(_V_GATE) + """select source, leaked_text, leaked_metadata, case when leaked_text + leaked_metadata = 0 then 'PASS'
  else 'FAIL' end as estado from m""")
def pii_leak_check(t: Tables) -> DataFrame:
    return measured(t).select("source", "leaked_text", "leaked_metadata", quality.leak_status().alias("estado"))


V_BASELINE = """base as (select avg(rows_out) as baseline_avg, count(*) as baseline_runs from (select * from runs
  where status = 'success' order by started_at desc, run_id limit 7) where rows_out > 0)"""


@query(ctes(V_RUNS, V_BASELINE) + """select run_id, rows_out, round(baseline_avg, 6) as baseline_avg, case when rows_out < 10
  then 'FAIL' when baseline_runs < 2 then 'PASS' when abs(rows_out - baseline_avg) / baseline_avg * 100 <= 70 then 'PASS'
  when abs(rows_out - baseline_avg) / baseline_avg * 100 <= 140 then 'WARN' else 'FAIL' end as estado from runs, base""")
def volume_check(t: Tables) -> DataFrame:
    """Every run judged against the mean of the last seven successes."""
    base = quality.baseline(t.runs())
    rows = t.runs().withColumn("baseline_avg", base.select("baseline_avg").scalar()).withColumn(
        "baseline_runs", base.select("baseline_runs").scalar())
    return scale(rows.select("run_id", "rows_out", "baseline_avg", quality.volume_status(
        F.col("rows_out"), F.col("baseline_avg"), F.col("baseline_runs")).alias("estado")))


@query(ctes(V_RUNS, V_BASELINE) + "select round(baseline_avg, 6) as baseline_avg, baseline_runs from base")
def volume_baseline(t: Tables) -> DataFrame:
    return scale(quality.baseline(t.runs()))


@query(ctes(_V_GATE, V_RUNS, V_BASELINE) + """select 'gate' as run_id, 'silver' as layer, overall, total as total_records,
    completeness, freshness, volume, schema, pii_leak from (select *, case when 'FAIL' in (completeness, freshness, volume,
      schema, pii_leak) then 'FAIL' when 'WARN' in (completeness, freshness, volume, schema, pii_leak) then 'WARN'
      else 'PASS' end as overall from (
    select sum(total)::bigint as total, case when sum(complete) * 100.0::double / sum(total) >= 95 then 'PASS'
      when sum(complete) * 100.0::double / sum(total) >= 90 then 'WARN' else 'FAIL' end as completeness,
      case when sum(future) > 0 then 'FAIL' else 'PASS' end as freshness,
      case when sum(total) < 10 then 'FAIL' when abs(sum(total) - any_value(baseline_avg)) / any_value(baseline_avg) * 100 <= 70
        then 'PASS' when abs(sum(total) - any_value(baseline_avg)) / any_value(baseline_avg) * 100 <= 140 then 'WARN'
        else 'FAIL' end as volume,
      case when sum(invalid) = 0 then 'PASS' else 'FAIL' end as schema,
      case when sum(leaked_text) + sum(leaked_metadata) = 0 then 'PASS' else 'FAIL' end as pii_leak from m, base))""")
def gate_report(t: Tables) -> DataFrame:
    runs = t.runs().withColumn("run_id", F.col("run_id").cast("string"))
    row = quality.report(faulty_posts(t), runs, "gate", "silver", F.lit(GATE_TIME).cast("timestamp"), as_of())
    names = ["completeness", "freshness", "volume", "schema", "pii_leak"]
    return quality.summary(row).select("run_id", "layer", "overall", "total_records",
                                       *[F.col("checks")[n].alias(n) for n in names])


@query(ctes(_V_GATE) + f"""select * from (select 'text_leak:' || id as violation from faulty where pii_detected
    and (regexp_matches(text_original, '{EMAIL}') or regexp_matches(text_original, '{PHONE}'))
  union all select 'meta_leak:' || id from faulty where names_left
  union all select 'schema:' || id from faulty where source_id is null) order by 1 limit 3""")
def gate_violations(t: Tables) -> DataFrame:
    return quality.violations(faulty_posts(t), 3)


@query(ctes(_V_GATE) + """select source, count(*) filter (where source_id is not null) as validos,
  count(*) filter (where source_id is null) as invalidos from faulty group by 1""")
def valid_and_quarantined(t: Tables) -> DataFrame:
    good, bad = quality.split_valid(faulty_posts(t), ["source"], lambda marked: stored(marked, "marked"))
    both = good.select("source", F.lit(None).cast("string").alias("error")).unionByName(bad.select("source", "error"))
    return both.groupBy("source").agg(F.count_if(F.col("error").isNull()).alias("validos"),
                                      F.count_if(F.col("error") == "source_id_missing").alias("invalidos"))


# --- reports ----------------------------------------------------------------------------------------------------------

V_REPORTS = """reports as (select cast(o_custkey as varchar) as run_id, case when o_orderpriority < '3' then 'silver' else 'gold'
    end as layer, case o_orderstatus when 'O' then 'PASS' when 'P' then 'WARN' else 'FAIL' end as overall,
    o_orderkey as total_records, o_orderdate as created_at from orders)"""


def reports(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    check = F.struct(F.lit("volume").alias("check"), status.alias("status"), F.lit(None).cast("string").alias("reason"),
                     F.create_map(F.lit("total"), F.col("o_orderkey").cast("string")).alias("detail"))
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("run_id"),
        F.when(F.col("o_orderpriority") < "3", "silver").otherwise("gold").alias("layer"),
        F.when(status == "O", "PASS").when(status == "P", "WARN").otherwise("FAIL").alias("overall"),
        F.col("o_orderkey").alias("total_records"), F.array(check).alias("checks"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"))


@query(ctes(V_REPORTS) + """select run_id, case when overall = 'FAIL' then 'CRITICAL' else 'WARNING' end as severity,
  'slack' as channel, '{"layer":"' || layer || '","overall":"' || overall || '"}' as payload, false as delivered
  from reports where overall <> 'PASS'""")
def alert_rows(t: Tables) -> DataFrame:
    return quality.alerts(reports(t)).drop("created_at")


@query(ctes(V_REPORTS) + """select total_records, strftime(created_at, '%Y-%m-%d') as dia from reports
  where layer = 'silver' and overall = 'FAIL' order by created_at desc, run_id, layer limit 50""")
def list_reports(t: Tables) -> DataFrame:
    newest = views.list_reports(reports(t), layer="silver", overall="FAIL", limit=views.REPORTS_PAGE)
    return newest.select("total_records", F.date_format("created_at", "yyyy-MM-dd").alias("dia"))


@query(ctes(V_REPORTS) + "select layer, overall, total_records from reports where run_id = '7'")
def reports_for_run(t: Tables) -> DataFrame:
    return views.reports_for_run(reports(t), "7").select("layer", "overall", "total_records")


@query(ctes(V_REPORTS) + "select total_records, case overall when 'PASS' then 'O' when 'WARN' then 'P' else 'F' end as volume from reports")
def report_summaries(t: Tables) -> DataFrame:
    return quality.summary(reports(t)).select("total_records", F.col("checks")["volume"].alias("volume"))


# --- run ledger -------------------------------------------------------------------------------------------------------

RUNS_TIME = "2001-08-02 00:00:00"
_T = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def runs_time():
    return F.lit(RUNS_TIME).cast("timestamp")


@query(ctes(V_RUNS) + f"""select flow_name, run_id, {_T.format('started_at')} as started_at, rows_out from (select *,
  row_number() over (partition by flow_name order by started_at desc, run_id) as k from runs where status = 'success')
  where k = 1""")
def last_success_by_flow(t: Tables) -> DataFrame:
    return views.last_success_by_flow(t.runs()).select("flow_name", "run_id", shown("started_at").alias("started_at"), "rows_out")


@query(ctes(V_RUNS) + """select run_id, status, cast(epoch(finished_at) - epoch(started_at) as int) as duration_seconds
  from runs order by started_at desc, run_id limit 50""")
def pipeline_health(t: Tables) -> DataFrame:
    return views.pipeline_health(t.runs(), views.HEALTH_PAGE).select("run_id", "status", "duration_seconds")


@query(ctes(V_RUNS) + f"""select w.w as "window",
  count(*) filter (where inside) as total_runs, count(*) filter (where inside and status = 'quality_failed') as quality_failed,
  coalesce(round(count(*) filter (where inside and status = 'quality_failed') / nullif(count(*) filter (where inside), 0), 4), 0)
    as failure_rate
  from (select w, status, started_at >= timestamp '{RUNS_TIME}' - to_hours(h) as inside from runs,
    (values ('24h', 24), ('7d', 168)) as s(w, h)) as w group by 1""")
def quality_failed_rate(t: Tables) -> DataFrame:
    return views.quality_failed_rate(t.runs(), runs_time())


@query(ctes(V_RUNS) + f"""select run_id, flow_name, status from runs where status = 'success' and flow_name = '2-HIGH'
  and started_at >= timestamp '{RUNS_TIME}' - interval 2400 hour order by started_at desc, run_id limit 200""")
def list_runs(t: Tables) -> DataFrame:
    return views.list_runs(t.runs(), "success", "2-HIGH", 2400, runs_time(), views.RUNS_PAGE).select("run_id", "flow_name", "status")


@query(ctes(V_RUNS) + "select run_id, status, rows_out from runs where run_id = 77")
def run_by_id(t: Tables) -> DataFrame:
    return views.run_by_id(t.runs(), 77).select("run_id", "status", "rows_out")


@query(ctes(V_RUNS) + f"""select run_id, flow_name, status, {_T.format('started_at')} as started_at,
  {_T.format('finished_at')} as finished_at, rows_out from runs""")
def current_runs(t: Tables) -> DataFrame:
    """Start and finish events of every run, resolved to its present state."""
    none = lambda kind: F.lit(None).cast(kind)
    runs = t.runs()
    extra = {"rows_in": none("bigint"), "quality_summary": none("map<string,string>"), "error": none("string")}
    start = runs.withColumns({"status": F.lit("running"), "finished_at": none("timestamp"), "rows_out": none("bigint"),
                              "version": F.lit("1"), **extra})
    finish = runs.withColumns({"flow_name": none("string"), "started_at": none("timestamp"), "version": F.lit("2"), **extra})
    rows = ledger.current_runs(start.unionByName(finish))
    return rows.select("run_id", "flow_name", "status", shown("started_at").alias("started_at"),
                       shown("finished_at").alias("finished_at"), "rows_out")


@query(ctes(V_POSTS, V_SILVER, V_RUNS) + """select capa, filas from (select 'raw' as capa, count(*) as filas from posts
  union all select 'silver', count(*) from silver union all select 'gold', count(*) from silver)""")
def layer_counts(t: Tables) -> DataFrame:
    raw = t.posts().withColumn("run_id", F.lit("run"))
    return views.layer_counts(raw, silver_posts(t), gold_posts(t), "run")


@query(ctes(V_RUNS) + """select l_orderkey, l_linenumber from lineitem where l_orderkey in (select run_id from runs
  where status = 'success' order by started_at desc, run_id limit 1)""")
def rows_of_latest_run(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("run_id", F.col("l_orderkey"))
    return views.in_latest_run(rows, t.runs()).select("l_orderkey", "l_linenumber")


@query(ctes(V_RUNS) + f"""select run_id, {_T.format('started_at')} as started_at from runs where status <> 'failed'
  and started_at >= timestamp '1998-01-01'""")
def incremental_scan(t: Tables) -> DataFrame:
    rows = t.runs().withColumn("is_duplicate", F.col("status") == "failed")
    got = files.since(rows, F.lit("1998-01-01").cast("timestamp"), "started_at")
    return got.select("run_id", shown("started_at").alias("started_at"))


@query(f"select {_T.format('max(ts)')} as ultima_fecha from events")
def high_water_mark(t: Tables) -> DataFrame:
    mark = files.high_water_mark(t.events.withColumn("datetime_utc", F.col("ts").cast("timestamp")))
    return mark.select(shown("ultima_fecha").alias("ultima_fecha"))


# --- dashboard --------------------------------------------------------------------------------------------------------

V_SCORED_GOLD = ",\n".join([
    V_POSTS, V_SILVER, "norm as (select *, text_clean as t from silver)", lexicon_sql(),
    """gold as (select source, datetime_utc, case label when 'POS' then 'positive' when 'NEG' then 'negative' else 'neutral'
         end as sentiment_label, case when label <> 'NEU' then p end as sentiment_score from scored)""",
])


def scored_gold(t: Tables) -> DataFrame:
    from agoralake.plans.layers import with_model_results
    found = silver_posts(t).select("id", scorers.LexiconScorer(POSITIVE, NEGATIVE).result(F.col("text_clean")).alias("r"))
    label = F.col("r.label")
    results = found.select(
        "id", F.when(label == "POS", "positive").when(label == "NEG", "negative").otherwise("neutral").alias("sentiment_label"),
        F.when(label != "NEU", F.col("r.score")).alias("sentiment_score"), F.lit(None).cast("string").alias("candidate_mentioned"))
    return with_model_results(gold_posts(t), results)


@query(ctes(V_SCORED_GOLD) + """select cast(datetime_utc as date) as day, source, count(*) as posts,
  count(*) filter (where sentiment_label = 'positive') as positive_count,
  count(*) filter (where sentiment_label = 'negative') as negative_count,
  count(*) filter (where sentiment_label = 'neutral') as neutral_count, round(avg(sentiment_score), 9) as avg_sentiment
  from gold where datetime_utc is not null group by 1, 2""")
def sentiment_daily(t: Tables) -> DataFrame:
    return scale(views.sentiment_daily(scored_gold(t)), 9)


_VOLUME = """select cast(datetime_utc as date) as day, source, count(*) as posts from silver
  where datetime_utc >= timestamp '2024-01-31' - interval 7 day group by 1, 2"""


@query(ctes(V_POSTS, V_SILVER) + _VOLUME)
def sources_volume_7d(t: Tables) -> DataFrame:
    return views.sources_volume(gold_posts(t), as_of())


@query(ctes(V_POSTS, V_SILVER) + f"select source, posts from ({_VOLUME})")
def sources_volume_brief(t: Tables) -> DataFrame:
    return views.sources_volume_brief(gold_posts(t), as_of())


@query(ctes(V_POSTS, V_SILVER, V_RUNS, f"vol as ({_VOLUME})") + """select 'sources_volume_7d' as bloque, count(*) as filas from vol
  union all select 'last_success_by_flow', count(distinct flow_name) from runs where status = 'success'
  union all select 'sentiment_daily', count(*) from (select distinct cast(datetime_utc as date), source from silver)
  union all select 'quality_failed_rate', 2""")
def metrics_summary(t: Tables) -> DataFrame:
    blocks = views.metrics_summary(gold_posts(t), t.runs(), as_of())
    out = None
    for name, df in blocks.items():
        one = df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("bloque"), "filas")
        out = one if out is None else out.unionByName(one)
    return out
