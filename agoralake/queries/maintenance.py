"""Queries over what jobs keep up: broken runs, known ids, maintained totals, pruned scans, scores in gold, long keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from agoralake.operators import feature_map as fm, feature_table as ft, scan, windows as wn
from agoralake.plans import jobs, rollups, scorers, views
from agoralake.queries.analysis import PREFIX, V_POLL_MEANS, scores_sql
from agoralake.queries.layers import _write_exports, twitter_export
from agoralake.queries.registry import PRIORITY_NETWORK, V_OPINIONS, V_POLLS, V_POSTS, Tables, as_of, ctes, network_of, query, scale
from agoralake.session import new_work_path, shuffles_freed, stored
from agoralake.sources import tables
from agoralake.sources.ids import IdIndex


def _lake(t: Tables, name: str, files: int = 2, compression: str = "none") -> tuple[jobs.Lake, str]:
    lake = jobs.Lake(t.spark, new_work_path(t.spark, name))
    with shuffles_freed(t.spark):
        _write_exports(twitter_export(t), f"{lake.root}/exports", files, compression=compression)
    return lake, f"{lake.root}/exports/*.csv*"


@query(ctes(V_POSTS) + """select 'failed' as antes, 'success' as despues, count(*) as en_raw, count(*) as en_silver, count(*) as en_gold,
  1 as terminadas from posts""")
def broken_run_is_finished(t: Tables) -> DataFrame:
    """A run that breaks off after it has stored its files; the next one over the same files takes all posts to gold."""
    lake, exports = _lake(t, "broken")
    seq, run_id = 1, lake.ledger().start("e2e", run_id="first")
    jobs.take_files(lake, exports, run_id, seq, goal="gold")
    jobs.store_bronze(lake, "twitter", run_id, seq)
    lake.ledger().finish(run_id, "failed", error="silver is down")
    before = lake.ledger().runs().where(F.col("run_id") == run_id).first()["status"]
    out = jobs.run_batch(lake, exports, "twitter", skip_gold=False, as_of=as_of())
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return lake.ledger().runs().where(F.col("run_id") == run_id).select(
        F.lit(before).alias("antes"), F.col("status").alias("despues"), count(lake.raw().latest()).alias("en_raw"),
        count(lake.silver().latest()).alias("en_silver"), count(lake.gold().latest()).alias("en_gold"),
        F.lit(len(out["resumed"])).alias("terminadas"))


@query("select 'o' || o_orderkey as id from orders where o_orderstatus = 'F' and o_custkey % 50 = 0")
def known_ids_of_a_batch(t: Tables) -> DataFrame:
    """Ids of two runs in the index; which of a batch are among them."""
    index = IdIndex(t.spark, new_work_path(t.spark, "ids"))
    name = F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id")
    for seq, status in enumerate(["O", "F"]):
        index.add(t.orders.where(F.col("o_orderstatus") == status).select(name), f"run{seq}", seq)
    return index.known(t.orders.where((F.col("o_custkey") % 50 == 0) & (F.col("o_orderstatus") != "O")).select(name))


_NETWORKS = " ".join(f"when '{k}' then '{v}'" for k, v in PRIORITY_NETWORK.items())


@query(f"""select cast(o_orderdate as date) as day, case o_orderpriority {_NETWORKS} else 'other' end as source, count(*) as posts,
  count(*) filter (where l = 'positive') as positive_count, count(*) filter (where l = 'negative') as negative_count,
  count(*) filter (where l = 'neutral') as neutral_count, round(avg(s), 6) as avg_sentiment
  from (select *, case when o_custkey % 3 = 0 then 'neutral' when o_orderstatus = 'F' then 'negative' else 'positive' end as l,
    case when o_custkey % 3 = 0 then null else cast(o_custkey % 100 as double) / 100 end as s from orders) where o_custkey % 7 <> 0 group by 1, 2""")
def maintained_daily_sentiment(t: Tables) -> DataFrame:
    """Totals kept up by inserts, corrections, deletes and a repeated batch, with a fold in between."""
    rows = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"), network_of("o_orderpriority").alias("source"),
        F.when(F.col("o_orderstatus") == "F", "negative").otherwise("positive").alias("sentiment_label"),
        (F.col("o_custkey") % 100 / 100).cast("double").alias("sentiment_score"))
    view = rollups.sentiment_view(t.spark, new_work_path(t.spark, "daily"))
    view.apply("insert-1", rows.where("o_orderstatus <> 'F'"))
    view.apply("insert-2", rows.where("o_orderstatus = 'F'"))
    view.fold()
    third = rows.where("o_custkey % 3 = 0")
    corrected = third.withColumn("sentiment_label", F.lit("neutral")).withColumn("sentiment_score", F.lit(None).cast("double"))
    for _ in range(2):
        view.apply("corrections", corrected, third)
        view.apply("insert-1", rows)  # folded: nothing happens
    gone = rows.where("o_custkey % 7 = 0")
    left = gone.withColumn("sentiment_label", F.when(F.col("o_custkey") % 3 == 0, "neutral").otherwise(F.col("sentiment_label"))).withColumn(
        "sentiment_score", F.when(F.col("o_custkey") % 3 != 0, F.col("sentiment_score")))
    view.apply("deletes", None, left)
    return scale(rollups.sentiment_daily(view.totals()), 6, "avg_sentiment")


@query(ctes(V_POSTS) + """select 'tw_' || seq as id from posts where datetime_utc >= timestamp '2024-01-15 12:00:00'""")
def contexts_since_a_day(t: Tables) -> DataFrame:
    """Posts of both contexts from a time on; folders of other days are not read."""
    lake, exports = _lake(t, "since")
    jobs.run_batch(lake, exports, "twitter", gate=False)
    return jobs.load_contexts(lake, F.lit("2024-01-15 12:00:00").cast("timestamp")).select("id")


@query(ctes(V_POSTS) + """select cast(datetime_utc as date) as day, 'twitter' as source, count(*) as posts, 1 as iguales
  from posts where datetime_utc is not null group by 1""")
def scores_reach_the_daily_view(t: Tables) -> DataFrame:
    """Batch job, analysis, scores back into gold: the stored view says what a full computation over gold says."""
    lake, exports = _lake(t, "scored", compression="gzip")
    jobs.run_batch(lake, exports, "twitter", skip_gold=False, as_of=as_of())
    jobs.run_analysis(lake, scorers.NeutralScorer())
    stored_view = tables.read_daily(t.spark, f"{lake.root}/public/v_sentiment_daily")
    whole = views.sentiment_daily(lake.gold().latest())
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ("posts", "positive_count", "negative_count", "neutral_count", "avg_sentiment")]
    return stored_view.alias("s").join(whole.alias("w"), ["day", "source"], "full").select(
        "day", "source", F.col("s.posts").alias("posts"), F.when(reduce(lambda a, b: a & b, same), 1).otherwise(0).alias("iguales"))


@query("""select o_orderkey, last_value(case when o_totalprice > 250000 then o_orderkey end ignore nulls) over w as ultima,
  cast(row_number() over w as bigint) as numero, cast(sum(o_custkey) over w as bigint) as suma
  from orders window w as (order by o_orderdate, o_orderkey rows unbounded preceding)""")
def running_values_of_one_long_key(t: Tables) -> DataFrame:
    """Number, sum and last large order along all orders, which are one key."""
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_custkey", F.lit(1).alias("todo"),
                           F.when(F.col("o_totalprice") > 250000, F.col("o_orderkey")).alias("grande"))
    pieces = scan.in_pieces(rows, ["todo"], ["o_orderdate", "o_orderkey"], 8)
    out = scan.running(pieces, ["todo"], ["o_orderdate", "o_orderkey"], {
        "ultima": ("last", "grande"), "numero": ("number", None), "suma": ("sum", "o_custkey")})
    return out.select("o_orderkey", "ultima", "numero", "suma")


@query("select event_id, lag(user_id) over (partition by event_type order by ts, event_id) as anterior from events")
def previous_values_of_long_keys(t: Tables) -> DataFrame:
    """The user of the event of the same kind before; a few kinds share all events."""
    rows = t.events.select("event_id", "event_type", "ts", "user_id")
    return scan.with_previous(rows, {"anterior": "user_id"}, ["ts", "event_id"], ["event_type"]).select("event_id", "anterior")


@query(ctes(V_OPINIONS, V_POLLS, V_POLL_MEANS) + """select o.id, round(pm.intencion_voto, 6) as intencion_voto, pm.fecha as asof_fecha
  from opinions o asof left join pm on pm.candidato = o.candidato and cast(o.fecha as date) >= pm.fecha""")
def asof_scan_by_candidate(t: Tables) -> DataFrame:
    """As asof_join_by_candidate, by one ordered pass over both sides."""
    left = t.opinions().select("id", "candidato", F.to_date("fecha").alias("dia"))
    out = scan.asof_scan(left, ft.poll_means(t.polls()), ["candidato"], "dia", "fecha", ["intencion_voto"])
    return scale(out.select("id", "intencion_voto", "asof_fecha"))


_NETS = " ".join(f"when '{k}' then '{v}'" for k, v in PREFIX.items())
_BY_CUSTOMER = V_OPINIONS.replace("c_mktsegment as candidato", "c_name as candidato")


@query(ctes(_BY_CUSTOMER, scores_sql("cs", "candidato"), f"""f as (select ventana, case red {_NETS} end || '1_' || entidad as nombre,
    avg(score_final) as v from cs group by 1, 2
  union all select ventana, 'SP1_' || entidad, avg(v) from (select ventana, red, entidad, avg(score_final) as v from cs group by 1, 2, 3) group by 1, 2)""")
       + "select ventana, count(*) as n, round(sum(v), 4) as suma, min(nombre) as primero from f group by 1")
def feature_maps_of_many_entities(t: Tables) -> DataFrame:
    """Every customer is an entity: features as maps, whatever their number."""
    who = t.customer.select(F.col("c_custkey"), F.col("c_name"))
    names = t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey").join(who, F.col("o_custkey") == F.col("c_custkey")).select("id", "c_name")
    rows = t.opinions().join(names, "id").withColumn("candidatos", F.array("c_name"))
    scores = wn.windowed_scores(rows, "candidatos", store=lambda dated: stored(dated, "dated"))
    maps = fm.feature_maps(fm.score_features(scores, 1))
    return maps.select("ventana", F.size("features").cast("bigint").alias("n"),
                       F.round(F.aggregate(F.map_values("features"), F.lit(0.0), lambda a, v: a + v), 4).alias("suma"),
                       F.array_min(F.map_keys("features")).alias("primero"))


class Refusing(scorers.BatchModel):
    """Fails on any batch that holds a text of an odd kind."""

    name, version = "refusing", "1.0"

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if any(x.startswith("x") for x in texts):
            raise ValueError("unreadable text")
        return [("POS", 0.5)] * len(texts)


@query("""select doc_id, case when doc_id % 41 = 0 then 0.0::double else 0.5::double end as score,
  case when doc_id % 41 = 0 then 'ValueError: unreadable text' end as score_error from documents""")
def texts_a_model_fails_on(t: Tables) -> DataFrame:
    """Texts at fault are found in their batches; all others keep their scores."""
    text = F.concat(F.when(F.col("doc_id") % 41 == 0, "x").otherwise("y"), F.coalesce("text", F.lit("")))
    rows = t.documents.select("doc_id", text.alias("texto_usuario_norm"), as_of().alias("fecha"))
    return scorers.with_sentiment(rows, scorers.ModelScorer(Refusing())).select("doc_id", "score", "score_error")


@query("""select 'CRITICAL' as severity, false as delivered, count(*) as n from (select 1)""")
def stored_alerts(t: Tables) -> DataFrame:
    """A run whose posts are of the future fails its gate and leaves an alert."""
    lake, exports = _lake(t, "alerts")
    jobs.run_batch(lake, exports, "twitter", as_of=F.lit("2020-01-01 00:00:00").cast("timestamp"))
    return lake.alerts().latest().groupBy("severity", "delivered").agg(F.count(F.lit(1)).alias("n"))


@query(ctes(V_POSTS) + """select 'twitter' as source, count(*) as filas, cast(sum(length(text)) as bigint) as letras from posts""")
def stored_landing(t: Tables) -> DataFrame:
    lake, exports = _lake(t, "landing")
    jobs.run_landing(lake, exports, "twitter")
    return lake.landing().latest().groupBy("source").agg(F.count(F.lit(1)).alias("filas"), F.sum(
        F.length(F.get_json_object("payload", "$.content"))).alias("letras"))
