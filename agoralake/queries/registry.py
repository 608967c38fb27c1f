"""Registry of queries and their oracle SQL, and the harness views both are built on.

The views give the tables the shape of posts, press mentions, polls, runs and reply chains. They use every row of the
tables they read. ``V_*`` is the same view as a CTE for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agoralake import schemas
from agoralake.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-01-31 00:00:00"


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the harness under its name, with the SQL that must give the same rows."""
    def add(fn: Callable[["Tables"], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(configure(spark), sf_dir))
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return add


def ctes(*parts: str) -> str:
    return "with recursive " + ",\n".join(parts) + "\n"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def scale(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Round the double columns, as the oracle does."""
    names = columns or [f.name for f in df.schema.fields if f.dataType == schemas.D]
    return df.withColumns({c: F.round(c, digits) for c in names})


def shown(c: Column | str) -> Column:
    """A timestamp as text, so that no driver setting changes it."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


NETWORKS = ["twitter", "youtube", "facebook", "tiktok", "other"]
PREFIXES = ["tw_", "yt_", "fb_", "tk_", "ext_"]


def _case(c: Column, values: list[str]) -> Column:
    out = F.lit(values[-1])
    for i, v in enumerate(values[:-1]):
        out = F.when(c == i, F.lit(v)).otherwise(out)
    return out


class Tables:
    """The given tables and the views over them, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def posts(self) -> DataFrame:
        """One post per document. Its interactions are an even share of all events, in event order."""
        # Partitioning by the join key is what a shuffle join would do anyway; both sides have one row per document.
        docs, events = self.documents.repartition("doc_id"), self.events
        shares = events.withColumn("_d", self.documents.agg(F.count(F.lit(1))).scalar()).withColumn(
            "_e", events.agg(F.count(F.lit(1))).scalar()).withColumn("doc_id", F.expr("(event_id * _d) div _e"))
        kind = lambda k: F.count_if(F.col("event_type") == k)
        acts = shares.groupBy("doc_id").agg(
            F.min("ts").cast("timestamp").alias("datetime_utc"), F.min_by("user_id", "event_id").alias("user_id"),
            kind("click").alias("likes"), kind("view").alias("views"), kind("signup").alias("retweets"),
            kind("error").alias("replies"), kind("purchase").alias("shares"))
        n = F.col("doc_id") % 5
        number = F.col("doc_id").cast("string")
        zero = lambda c: F.coalesce(c, F.lit(0))
        counts = ["likes", "views", "retweets", "replies", "shares"]
        return docs.join(acts, "doc_id", "left").select(
            F.concat(_case(n, PREFIXES), number).alias("id"), _case(n, NETWORKS).alias("source"),
            number.alias("source_id"), F.substring(F.md5("text"), 1, 16).alias("content_id"),
            F.col("doc_id").alias("seq"), "datetime_utc",
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username"), "text",
            F.lit(None).cast("string").alias("parent_id"),
            F.create_map(*[x for c in counts for x in (F.lit(c), zero(c))]).alias("engagement"),
            F.create_map(F.lit("title"), F.concat(F.lit("Nota "), "source"), F.lit("tags"), F.col("lang"),
                         F.lit("user_nickname"), F.concat(F.lit("user_"), F.col("user_id").cast("string"))
                         ).alias("metadata"),
            *[zero(c).alias(c) for c in counts], "lang", F.col("source").alias("outlet"))

    def content_posts(self) -> DataFrame:
        """Posts whose id is a hash of the text, so exact copies share it."""
        return self.posts().withColumn("id", F.col("content_id"))

    def opinions(self) -> DataFrame:
        """Dated, scored statements: one per order, about a market segment and a region."""
        places = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        who = self.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "c_custkey", "c_mktsegment", "r_name")
        status = F.col("o_orderstatus")
        return self.orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("id"), network_of("o_orderpriority").alias("red"),
            F.col("o_orderdate").cast("timestamp").alias("fecha"),
            F.when(status == "O", 0.6).when(status == "F", -0.4).otherwise(0.0).alias("score"),
            F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).alias("intencion_explicita"),
            F.floor(F.col("o_totalprice") / 1000).cast("double").alias("engagement"),
            F.array("c_mktsegment").alias("candidatos"), F.array("r_name").alias("partidos"),
            F.col("c_mktsegment").alias("candidato"), F.col("r_name").alias("partido"))

    def mentions(self) -> DataFrame:
        """Press mentions per day, outlet and candidate."""
        rows = self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
        return rows.groupBy(F.col("o_orderdate").cast("date").alias("fecha"), F.col("o_orderpriority").alias("medio"),
                            F.col("c_mktsegment").alias("candidato")).agg(F.count(F.lit(1)).alias("menciones"))

    def polls(self) -> DataFrame:
        """Weekly measurements per pollster and candidate, published nine days after the week begins."""
        rows = self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
        week = F.date_add(F.date_trunc("week", F.col("o_orderdate").cast("timestamp")).cast("date"), 9)
        return rows.groupBy(week.alias("fecha"), F.col("o_orderpriority").alias("encuestadora"),
                            F.col("c_mktsegment").alias("candidato")).agg(
            F.round(F.sum("o_totalprice") / 1e7, 4).alias("intencion_voto"))

    def runs(self) -> DataFrame:
        status = F.col("o_orderstatus")
        started = F.col("o_orderdate").cast("timestamp")
        return self.orders.select(
            F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("flow_name"),
            F.when(status == "O", "success").when(status == "F", "failed").otherwise("quality_failed").alias("status"),
            started.alias("started_at"),
            F.timestamp_seconds(F.unix_seconds(started) + F.col("o_custkey") % 600).alias("finished_at"),
            F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("rows_out"))

    def replies(self) -> DataFrame:
        key = lambda turn: F.concat(F.lit("yt_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))
        return self.conversations.select(
            key(F.col("turn")).alias("id"), F.when(F.col("turn") > 0, key(F.col("turn") - 1)).alias("parent_id"),
            F.col("conv_id").cast("string").alias("video_id"), "turn", "role", "text")


# Order priorities stand for networks.
PRIORITY_NETWORK = {
    "1-URGENT": "facebook", "2-HIGH": "youtube", "3-MEDIUM": "tiktok", "4-NOT SPECIFIED": "twitter", "5-LOW": "other",
}


def network_of(column: str) -> Column:
    out = F.lit("other")
    for priority, network in PRIORITY_NETWORK.items():
        out = F.when(F.col(column) == priority, network).otherwise(out)
    return out


_CASES = " ".join(f"when '{k}' then '{v}'" for k, v in PRIORITY_NETWORK.items())

V_POSTS = """
posts as (
  select case d.doc_id % 5 when 0 then 'tw_' when 1 then 'yt_' when 2 then 'fb_' when 3 then 'tk_' else 'ext_' end
           || cast(d.doc_id as varchar) as id,
         case d.doc_id % 5 when 0 then 'twitter' when 1 then 'youtube' when 2 then 'facebook' when 3 then 'tiktok'
           else 'other' end as source,
         cast(d.doc_id as varchar) as source_id, substring(md5(d.text), 1, 16) as content_id, d.doc_id as seq,
         a.datetime_utc, 'user_' || cast(a.user_id as varchar) as username, d.text,
         coalesce(a.likes, 0) as likes, coalesce(a.views, 0) as views, coalesce(a.retweets, 0) as retweets,
         coalesce(a.replies, 0) as replies, coalesce(a.shares, 0) as shares, d.lang, d.source as outlet
  from documents d left join (
    select event_id * (select count(*) from documents) // (select count(*) from events) as doc_id,
           min(ts) as datetime_utc, arg_min(user_id, event_id) as user_id,
           count(*) filter (where event_type = 'click') as likes, count(*) filter (where event_type = 'view') as views,
           count(*) filter (where event_type = 'signup') as retweets,
           count(*) filter (where event_type = 'error') as replies,
           count(*) filter (where event_type = 'purchase') as shares
    from events group by 1) a on a.doc_id = d.doc_id)"""

V_OPINIONS = f"""
opinions as (
  select o_orderkey as id, case o_orderpriority {_CASES} else 'other' end as red, o_orderdate as fecha,
         case o_orderstatus when 'O' then 0.6::double when 'F' then -0.4::double else 0::double end as score,
         case when o_totalprice > 250000 then 1 else 0 end as intencion_explicita,
         cast(floor(o_totalprice / 1000) as double) as engagement, c_mktsegment as candidato, r_name as partido
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey)"""

V_MENTIONS = """
mentions as (
  select cast(o_orderdate as date) as fecha, o_orderpriority as medio, c_mktsegment as candidato, count(*) as menciones
  from orders join customer on o_custkey = c_custkey group by 1, 2, 3)"""

V_POLLS = """
polls as (
  select cast(date_trunc('week', o_orderdate) as date) + 9 as fecha, o_orderpriority as encuestadora,
         c_mktsegment as candidato, round(sum(o_totalprice) / 1e7, 4) as intencion_voto
  from orders join customer on o_custkey = c_custkey group by 1, 2, 3)"""

V_RUNS = """
runs as (
  select o_orderkey as run_id, o_orderpriority as flow_name,
         case o_orderstatus when 'O' then 'success' when 'F' then 'failed' else 'quality_failed' end as status,
         cast(o_orderdate as timestamp) as started_at,
         cast(o_orderdate as timestamp) + to_seconds(o_custkey % 600) as finished_at,
         cast(floor(o_totalprice / 1000) as bigint) as rows_out
  from orders)"""

V_REPLIES = """
replies as (
  select 'yt_' || cast(conv_id as varchar) || '_' || cast(turn as varchar) as id,
         case when turn > 0 then 'yt_' || cast(conv_id as varchar) || '_' || cast(turn - 1 as varchar) end as parent_id,
         cast(conv_id as varchar) as video_id, turn, role, text
  from conversations)"""
