"""Queries over mappers, deduplication, layer transforms, stored tables, jobs and the inbox stream."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, functions as F

from agoralake import schemas
from agoralake.functions import pii
from agoralake.operators import dedupe as dd
from agoralake.plans import jobs, layers, scorers, views
from agoralake.queries.registry import (
    AS_OF, V_MENTIONS, V_POSTS, V_REPLIES, Tables, as_of, ctes, query, scale, shown,
)
from agoralake.queries.text import (
    ALIASES, DICTIONARIES, PHRASES, REPORTING, S, V_ALIAS_HITS, V_CANDIDATES, V_FUZZY, V_PARTIES, _ES, clean_sql, mask_sql,
    norm_sql,
)
from agoralake.session import new_work_path
from agoralake.sources import files, mappers, media, tables
from agoralake.streaming import inbox

_TRIM = f"regexp_replace({{}}, '^[{S}]+|[{S}]+$', '', 'g')"
TEXT = _TRIM.replace("{}", "text", 1)
_LANG_OF = f"""case when length({TEXT}) < 3 then null
    when len(list_filter(list_distinct(regexp_split_to_array(lower(text), '[{S}]+')), lambda x: list_contains({_ES}, x))) >= 1
     and len(list_filter(list_distinct(regexp_split_to_array(lower(text), '[{S}]+')), lambda x: list_contains({_ES}, x)))
       / len(list_filter(list_distinct(regexp_split_to_array(lower(text), '[{S}]+')), lambda x: x <> '')) >= 0.10
    then 'es' else 'unknown' end"""

V_SILVER = f"""silver as (select content_id as id, source, source_id, datetime_utc, username as author_id,
    {clean_sql('text')} as text_clean, {mask_sql('text')} as text_original, {mask_sql('text')} <> text as pii_detected,
    {_LANG_OF} as lang, likes, views, retweets, replies, shares, seq
  from (select *, row_number() over (partition by content_id order by seq) as rn from posts) where rn = 1)"""

V_GOLD = """gold as (select id, source, datetime_utc,
    case when text_clean = '' then 0 else len(string_split(text_clean, ' ')) end as word_count,
    length(text_clean) as char_count, hour(datetime_utc) as hour_of_day, isodow(datetime_utc) - 1 as day_of_week,
    cast(floor((epoch_us(timestamp '2026-05-31') - epoch_us(datetime_utc)) / 86400000000.0) as int) as days_until_election,
    ln(1 + likes + retweets * 2 + shares * 2 + replies * 3 + views * 0.01::double) as engagement_score
  from silver)"""


def silver_posts(t: Tables, mask_first: bool = False) -> DataFrame:
    good, _ = layers.to_silver(t.content_posts().drop("content_id"), None, "run", as_of(), mask_first=mask_first)
    return good


def gold_posts(t: Tables) -> DataFrame:
    return layers.to_gold(silver_posts(t), "run", as_of())


@query(ctes(V_POSTS, V_SILVER, V_GOLD) + """select cast(datetime_utc as date) as day, source, count(*) as posts,
  cast(sum(word_count) as bigint) as words, cast(sum(char_count) as bigint) as chars,
  round(avg(engagement_score), 6) as engagement, min(days_until_election) as days_left from gold group by 1, 2""")
def daily_volume_of_clean_posts(t: Tables) -> DataFrame:
    gold = gold_posts(t).withColumn("engagement_score", F.col("engagement_score"))
    exact = layers.scoring.engagement_score(F.col("engagement"), None)
    return scale(gold.groupBy(F.to_date("datetime_utc").alias("day"), "source").agg(
        F.count(F.lit(1)).alias("posts"), F.sum("word_count").alias("words"), F.sum("char_count").alias("chars"),
        F.avg(exact).alias("engagement"), F.min("days_until_election").alias("days_left")))


@query(ctes(V_POSTS, V_SILVER) + """select id, source, source_id, strftime(datetime_utc, '%Y-%m-%d %H:%M:%S') as at,
  author_id, md5(text_clean) as clean_md5, md5(text_original) as original_md5, lang, pii_detected, likes,
  false as is_duplicate, 'tags,title' as metadata_keys from silver""")
def silver_rows(t: Tables) -> DataFrame:
    return silver_posts(t).select(
        "id", "source", "source_id", shown("datetime_utc").alias("at"), "author_id", F.md5("text_clean").alias("clean_md5"),
        F.md5("text_original").alias("original_md5"), "lang", "pii_detected", F.col("engagement")["likes"].alias("likes"),
        "is_duplicate", F.array_join(F.array_sort(F.map_keys("metadata")), ",").alias("metadata_keys"))


@query(ctes(V_POSTS) + f"""select content_id as id, md5({clean_sql(mask_sql('text'))}) as clean_md5
  from (select *, row_number() over (partition by content_id order by seq) as rn from posts) where rn = 1""")
def silver_rows_masked_first(t: Tables) -> DataFrame:
    return silver_posts(t, mask_first=True).select("id", F.md5("text_clean").alias("clean_md5"))


@query(ctes(V_POSTS, V_SILVER, V_GOLD) + """select id, source, word_count, char_count, hour_of_day, day_of_week,
  days_until_election, round(engagement_score, 3) as engagement_score, null::varchar as sentiment_label from gold""")
def gold_features(t: Tables) -> DataFrame:
    rows = gold_posts(t)
    exact = layers.scoring.engagement_score(F.col("engagement"), None)
    return rows.select("id", "source", "word_count", "char_count", "hour_of_day", "day_of_week", "days_until_election",
                       F.round(exact, 3).alias("engagement_score"), "sentiment_label")


@query(ctes(V_POSTS, V_SILVER, V_GOLD) + f"""select id, case when quality = 1 then 'positive' when quality = 0 then 'negative'
  end as sentiment_label, case when quality is not null then 0.75::double end as sentiment_score,
  case when quality is not null and toxic = 1 then 'Alfa Uno, Beta Dos' end as candidate_mentioned
  from gold left join (select s.id as lid, l.* from silver s join labels l on l.doc_id = s.seq) on lid = id""")
def model_results_written_back(t: Tables) -> DataFrame:
    first = dd.dedupe(t.content_posts().select("id", "seq"), ["id"], ["seq"], keep="first")
    found = first.join(t.labels, F.col("seq") == F.col("doc_id")).select(
        "id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("sentiment_label"),
        F.lit(0.75).alias("sentiment_score"),
        layers.candidate_slot(F.when(F.col("toxic") == 1, F.array(F.lit("Alfa Uno"), F.lit("Beta Dos"))).otherwise(
            F.array().cast("array<string>"))).alias("candidate_mentioned"))
    return layers.with_model_results(gold_posts(t), found).select(
        "id", "sentiment_label", "sentiment_score", "candidate_mentioned")


V_STANDARD = ",\n".join([
    V_POSTS, V_SILVER,
    f"""own as (select s.*, {norm_sql('text_clean')} as texto_usuario_norm, 'Nota ' || outlet || ' ' || p.lang as ctx
      from silver s join (select seq, outlet, lang from posts) p using (seq))""",
    f"""norm as (select *, trim(text_clean || ' ' || ctx) as texto, {norm_sql("(text_clean || ' ' || ctx)")} as t from own
      where texto_usuario_norm <> '' and len(string_split(texto_usuario_norm, ' ')) >= 5)""",
    V_ALIAS_HITS, V_FUZZY, V_CANDIDATES, V_PARTIES,
])


@query(ctes(V_STANDARD) + """select id, source as red, md5(texto) as texto_md5, md5(texto_usuario_norm) as usuario_md5,
  strftime(datetime_utc - interval 5 hour, '%Y-%m-%d %H:%M:%S') as fecha,
  round(case source when 'tiktok' then likes + shares * 2.0::double
    when 'twitter' then likes + retweets * 2 + replies * 1.5::double else likes end, 6) as engagement,
  (select string_agg(entity, '|' order by entity) from cands c where c.seq = n.seq) as candidatos,
  (select string_agg(party, '|' order by party) from parties p where p.seq = n.seq) as partidos from norm n""")
def analysis_rows(t: Tables) -> DataFrame:
    rows = layers.standardise(silver_posts(t), **DICTIONARIES)
    joined = lambda c: F.nullif(F.array_join(c, "|"), F.lit("")).alias(c)
    return scale(rows.select("id", "red", F.md5("texto").alias("texto_md5"), F.md5("texto_usuario_norm").alias("usuario_md5"),
                             shown("fecha").alias("fecha"), "engagement", joined("candidatos"), joined("partidos")))


@query(ctes(V_POSTS) + """select count(*) as total, count(*) filter (where n >= 5) as validos from
  (select case when c = '' then 0 else len(string_split(c, ' ')) end as n from (select """ + norm_sql("text") +
       " as c from posts))")
def minimum_length(t: Tables) -> DataFrame:
    n = layers.text.word_count(layers.text.analysis_text(F.col("text")))
    return t.posts().agg(F.count(F.lit(1)).alias("total"), F.count_if(n >= layers.MIN_WORDS).alias("validos"))


# --- deduplication, anti-joins, unions --------------------------------------------------------------------------------

def _ranked(order: str) -> str:
    return f"(select *, row_number() over (partition by content_id order by {order}) as rn from posts)"


@query(ctes(V_POSTS) + f"select content_id as id, seq, source from {_ranked('seq desc')} where rn = 1")
def dedupe_keep_last(t: Tables) -> DataFrame:
    return dd.dedupe(t.content_posts().select("id", "seq", "source"), ["id"], ["seq"], keep="last")


@query(ctes(V_POSTS) + f"select content_id as id, seq, source from {_ranked('seq')} where rn = 1")
def dedupe_keep_first(t: Tables) -> DataFrame:
    return dd.dedupe(t.content_posts().select("id", "seq", "source"), ["id"], ["seq"], keep="first")


@query(ctes(V_POSTS) + f"select content_id as id, seq from {_ranked('seq')} where rn > 1")
def duplicate_rows(t: Tables) -> DataFrame:
    return dd.losers(t.content_posts().select("id", "seq"), ["id"], ["seq"], keep="first")


@query(ctes(V_POSTS) + """select clave, seq from (select *, row_number() over (partition by clave order by seq) as rn
  from (select case when lang = 'fr' then null when lang = 'de' then '' else content_id end as clave, seq from posts))
  where rn = 1 or coalesce(clave, '') = ''""")
def dedupe_with_null_keys(t: Tables) -> DataFrame:
    key = F.when(F.col("lang") == "fr", F.lit(None)).when(F.col("lang") == "de", "").otherwise(F.col("content_id"))
    return dd.dedupe(t.posts().select(key.alias("clave"), "seq"), ["clave"], ["seq"], keep="first", keep_null_keys=True)


@query(ctes(V_POSTS) + """select content_id as id, seq from posts where content_id not in
  (select content_id from posts join labels on doc_id = seq)""")
def unseen_posts(t: Tables) -> DataFrame:
    posts = t.content_posts().select("id", "seq")
    seen = posts.join(t.labels, F.col("seq") == F.col("doc_id"), "left_semi")
    return dd.unseen(posts, seen, ["id"])


@query(ctes(V_POSTS) + """select id, prioridad, seq from (select *, row_number() over (partition by id order by prioridad, seq)
  as rn from (select content_id as id, 0 as prioridad, seq from posts where lang in ('es', 'fr')
    union all select content_id, 1, seq from posts)) where rn = 1""")
def union_of_two_contexts(t: Tables) -> DataFrame:
    posts = t.content_posts().select("id", "seq", "lang")
    first = posts.where(F.col("lang").isin("es", "fr")).select("id", F.lit(0).alias("prioridad"), "seq")
    return dd.union_by_priority([first, posts.select("id", F.lit(1).alias("prioridad"), "seq")], ["id"], ["seq"])


@query(ctes(V_POSTS, V_REPLIES) + """select 'posts' as origen, count(*) as n, cast(sum(length(text)) as bigint) as letras
  from posts union all select 'replies', count(*), cast(sum(length(text)) as bigint) from replies
  union all select 'pages', count(*), cast(sum(length(html)) as bigint) from pages""")
def union_of_sources(t: Tables) -> DataFrame:
    part = lambda name, df: df.select(F.lit(name).alias("origen"), F.col(df.columns[0]).alias("text"))
    rows = dd.union_all([part("posts", t.posts().select("text")), part("replies", t.replies().select("text")),
                         part("pages", t.pages.select("html"))])
    return rows.groupBy("origen").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("letras"))


@query(ctes(V_REPLIES) + """select video_id, id, turn from (select *, row_number() over (partition by video_id
  order by turn desc, id) as k from replies) where k <= 3""")
def newest_replies_per_video(t: Tables) -> DataFrame:
    rows = t.replies().select("video_id", "id", "turn")
    return dd.first_n_per_group(rows, ["video_id"], [F.col("turn").desc(), F.col("id")], 3)


@query("""select l_orderkey, l_linenumber, l_suppkey from (select *, row_number() over (partition by l_suppkey
  order by l_shipdate desc, l_orderkey, l_linenumber) as k from lineitem) where k <= 5""")
def capped_rows_per_group(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    order = [F.col("l_shipdate").desc(), F.col("l_orderkey"), F.col("l_linenumber")]
    return dd.first_n_per_group(rows, ["l_suppkey"], order, 5).drop("l_shipdate")


@query(ctes(V_REPLIES) + """select r.id, r.parent_id, md5(p.text) as parent_md5 from replies r
  left join replies p on p.id = r.parent_id""")
def reply_parents(t: Tables) -> DataFrame:
    return views.replies_with_parents(t.replies()).select("id", "parent_id", F.md5("parent_text").alias("parent_md5"))


@query(ctes(V_REPLIES) + """select video_id, count(*) filter (where parent_id is null) as comentarios,
  count(*) filter (where parent_id is not null) as respuestas from replies group by 1""")
def roots_and_replies(t: Tables) -> DataFrame:
    return views.roots_and_replies(t.replies(), "video_id")


@query(ctes(V_POSTS) + """select texto_usuario_norm, fecha, origen, seq from (select *, row_number() over
    (partition by texto_usuario_norm, fecha order by origen desc, seq desc) as rn from (
    select content_id as texto_usuario_norm, cast(datetime_utc as date) as fecha, 'nuevo' as origen, seq from posts
    union all select content_id, cast(datetime_utc as date), 'anterior', seq from posts where lang <> 'en'))
  where rn = 1""")
def scored_checkpoint_merge(t: Tables) -> DataFrame:
    rows = t.posts().select(F.col("content_id").alias("texto_usuario_norm"), F.to_date("datetime_utc").alias("fecha"),
                            "seq", "lang")
    old = rows.where(F.col("lang") != "en").withColumn("origen", F.lit("anterior"))
    return tables.merged_checkpoint(old, rows.withColumn("origen", F.lit("nuevo")), ["seq"]).drop("lang")


# --- mappers ----------------------------------------------------------------------------------------------------------

def _text(c: str) -> Column:
    return F.col(c).cast("string")


def twitter_export(t: Tables) -> DataFrame:
    return t.posts().select(
        F.concat(_text("seq"), F.lit(".0")).alias("id"), F.concat(F.lit("q "), "lang").alias("Query"),
        shown("datetime_utc").alias("datetime"), "username", F.col("text").alias("content"),
        F.concat(_text("replies"), F.lit(".7")).alias("replies"), F.when(F.col("retweets") > 0, _text("retweets")).alias(
            "retweets"), _text("likes").alias("likes"))


def _count(name: str) -> Column:
    return F.try_element_at("engagement", F.lit(name)).alias(name)


def _meta(name: str) -> Column:
    return F.try_element_at("metadata", F.lit(name)).alias(name)


_AT = "strftime(datetime_utc, '%Y-%m-%d %H:%M:%S')"


@query(ctes(V_POSTS) + f"""select 'tw_' || seq as id, 'twitter' as source, cast(seq as varchar) as source_id,
  {_AT} as datetime_utc, username, md5({TEXT}) as text_md5, replies, nullif(retweets, 0) as retweets, likes,
  'q ' || lang as query from posts""")
def map_twitter(t: Tables) -> DataFrame:
    good, _ = mappers.map_posts(twitter_export(t), "twitter")
    return good.select("id", "source", "source_id", "datetime_utc", "username", F.md5("text").alias("text_md5"),
                       _count("replies"), _count("retweets"), _count("likes"), _meta("query"))


@query(ctes(V_REPLIES) + f"""select id, 'youtube' as source, substr(id, 4) as source_id, parent_id, md5({TEXT}) as text_md5,
  turn as likes, null::bigint as views, video_id, role as video_title from replies""")
def map_youtube(t: Tables) -> DataFrame:
    raw = t.replies().select(
        F.when(F.col("turn") % 2 == 0, F.col("id")).otherwise(F.substr("id", F.lit(4))).alias("id"), "parent_id",
        F.lit(None).cast("string").alias("date"), "text", F.lit("nan").alias("username"), _text("turn").alias("likes"),
        F.lit("").alias("views"), "video_id", F.col("role").alias("video_title"), F.lit("None").alias("query"))
    good, _ = mappers.map_posts(raw, "youtube")
    return good.select("id", "source", "source_id", "parent_id", F.md5("text").alias("text_md5"), _count("likes"),
                       _count("views"), _meta("video_id"), _meta("video_title"))


def _tiktok(t: Tables) -> DataFrame:
    return t.posts().select(
        _text("shares").alias("video_id"), F.when(F.col("lang") != "de", _text("seq")).alias("comment_id"),
        shown("datetime_utc").alias("create_time"), F.when(F.col("lang") == "en", F.col("username")).alias("user_unique_id"),
        F.concat(F.lit("nick "), "username").alias("user_nickname"), "text", _text("likes").alias("digg_count"),
        _text("replies").alias("reply_count"))


@query(ctes(V_POSTS) + f"""select 'tk_' || seq as id, case when lang = 'en' then username else 'nick ' || username end
  as username, md5({TEXT}) as text_md5, likes, replies, cast(shares as varchar) as video_id from posts where lang <> 'de'""")
def map_tiktok(t: Tables) -> DataFrame:
    good, _ = mappers.map_posts(_tiktok(t), "tiktok")
    return good.select("id", "username", F.md5("text").alias("text_md5"), _count("likes"), _count("replies"),
                       _meta("video_id"))


@query(ctes(V_POSTS) + """select error, count(*) as filas from (select case when lang = 'de' then 'comment_id missing' end
  as error from posts) where error is not null group by 1""")
def rejected_rows(t: Tables) -> DataFrame:
    _, bad = mappers.map_posts(_tiktok(t), "tiktok")
    return bad.groupBy("error").agg(F.count(F.lit(1)).alias("filas"))


@query(ctes(V_POSTS) + f"""select 'fb_' || substr(md5(text || cast(cast(datetime_utc as date) as varchar)), 1, 16) as id,
  cast(cast(datetime_utc as date) as varchar) as datetime_utc, null::varchar as username, md5({TEXT}) as text_md5, likes,
  outlet as post_title, cast(seq as varchar) || '.csv' as source_file, null::varchar as detection_layer from posts""")
def map_facebook(t: Tables) -> DataFrame:
    raw = t.posts().select(
        F.col("outlet").alias("titulo_post"), F.col("text").alias("comentario"), _text("likes").alias("likes"),
        F.to_date("datetime_utc").cast("string").alias("fecha"), F.concat(_text("seq"), F.lit(".csv")).alias("archivo_origen"),
        F.lit("nan").alias("capa_deteccion"))
    good, _ = mappers.map_posts(raw, "facebook")
    return good.select("id", "datetime_utc", "username", F.md5("text").alias("text_md5"), _count("likes"),
                       _meta("post_title"), _meta("source_file"), _meta("detection_layer"))


@query(f"""select 'fb_' || substr(md5(x || url), 1, 16) as id, md5({_TRIM.replace('{}', 'x', 1)}) as text_md5, page_id as likes,
  url as post_url from (select page_id, url, 'visto en ' || url as x from pages)
  union all select 'fb_' || substr(md5(x || u), 1, 16), md5({_TRIM.replace('{}', 'x', 1)}), doc_id, u from
  (select doc_id, 'u' || doc_id as u, regexp_replace(text, '[\\r\\n\\x{{0B}}\\x{{0C}}\\x{{85}}\\x{{1C}}-\\x{{1E}}\\x{{2028}}\\x{{2029}}]', ' ', 'g') as x from documents)""")
def map_facebook_nested(t: Tables) -> DataFrame:
    """Nested lines made of documents and pages: wrapped twice, wrongly decoded, with rows that hold only a link."""
    flat = F.regexp_replace("text", r"[\r\n\x{0B}\x{0C}\x{85}\x{1C}-\x{1E}\x{2028}\x{2029}]", " ")
    docs = t.documents.select(flat.alias("x"), F.concat(F.lit("u"), _text("doc_id")).alias("u"), _text("doc_id").alias("n"))
    pages = t.pages.select(F.concat(F.lit("visto en "), "url").alias("x"), F.col("url").alias("u"), _text("page_id").alias("n"))
    links = t.pages.select(F.col("url").alias("x"), F.col("url").alias("u"), _text("page_id").alias("n"))
    rows = docs.unionByName(pages).unionByName(links)
    options = {"quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    wrong = F.when(F.col("x").rlike(r"^[\x{00}-\x{7F}]*$"), F.col("x")).otherwise(F.decode(F.encode("x", "UTF-8"), "ISO-8859-1"))
    # Control characters from the wrong decoding would break lines; such texts stay as they are.
    safe = F.when(wrong.rlike(r"[\x{80}-\x{9F}]"), F.col("x")).otherwise(wrong)
    inner = F.to_csv(F.struct(F.lit("t").alias("a"), F.lit("d").alias("b"), safe.alias("c"), F.col("n").alias("d"),
                              F.col("u").alias("e")), options)
    lines = rows.select(F.to_csv(F.struct(inner.alias("a"), F.lit("").alias("b")), options).alias("value"))
    good, _ = mappers.map_posts(files.parse_nested_lines(lines), "fb_parlamentarias")
    return good.select("id", F.md5("text").alias("text_md5"), _count("likes").alias("likes"), _meta("post_url"))


@query(ctes(V_POSTS) + f"""select 'ext_' || seq as id, 'other' as source, cast(seq as varchar) as source_id,
  {_AT} as datetime_utc, username, md5({TEXT}) as text_md5, 'external_csv' as import_source from posts""")
def map_external(t: Tables) -> DataFrame:
    raw = t.posts().select(_text("seq").alias("id"), F.col("text").alias("mensaje"), shown("datetime_utc").alias("fecha"),
                           F.col("username").alias("usuario"))
    good, _ = mappers.map_posts(raw, "external")
    return good.select("id", "source", "source_id", "datetime_utc", "username", F.md5("text").alias("text_md5"),
                       _meta("import_source"))


@query(ctes(V_POSTS) + f"""select 'tw_' || seq as id, 'r1' as run_id, 'local://processed/' as storage_path,
  md5({TEXT}) as text_md5, likes, 'q ' || lang as query from posts""")
def raw_payload_round_trip(t: Tables) -> DataFrame:
    """Posts -> raw rows -> payload as JSON text -> posts again."""
    good, _ = mappers.map_posts(twitter_export(t), "twitter")
    raw = mappers.raw_rows(good, "r1", as_of()).withColumn("payload", F.to_json("raw_payload"))
    back = mappers.posts_of_json(raw.drop("raw_payload")).join(raw.select("id", "run_id", "storage_path"), "id")
    return back.select("id", "run_id", "storage_path", F.md5("text").alias("text_md5"), _count("likes"), _meta("query"))


@query("""select user_id, null::varchar as nombre_visible, event_id from (select *, row_number() over
  (partition by clave order by event_id) as rn from (select case when event_type = 'error' then null
  else cast(floor(value) as bigint) end as clave, sha256(cast(user_id as varchar)) as user_id, event_id from events))
  where rn = 1 or clave is null""")
def anonymised_export(t: Tables) -> DataFrame:
    raw = t.events.select(
        F.when(F.col("event_type") != "error", F.floor("value").cast("string")).alias("comment_id"),
        _text("user_id").alias("user_id"), F.concat(F.lit("nick "), _text("user_id")).alias("user_nickname"), "event_id")
    out = mappers.anonymised_export(raw, "comment_id", ["user_nickname"], ["user_id"], ["event_id"])
    return out.select("user_id", F.lit(None).cast("string").alias("nombre_visible"), "event_id")


@query(ctes(V_POSTS) + """select id, lang as "Query", case when lang = 'en' then null else text_md5 end as content from
  (select id, lang, md5(text) as text_md5 from posts)""")
def aligned_append(t: Tables) -> DataFrame:
    rows = t.posts().select("id", "lang", F.md5("text").alias("content"))
    old = rows.where(F.col("lang") != "en").select("id", F.col("lang").alias("query"), "content")
    return mappers.aligned_append(old, rows.where(F.col("lang") == "en").select(F.col("lang").alias("Query"), "id"))


# --- media and videos -------------------------------------------------------------------------------------------------

@query("""select cast(o_orderkey as varchar) as article_id, c_mktsegment as candidato, o_orderpriority as medio,
  cast(o_orderdate as date) as fecha, case when o_orderstatus = 'P' then 1 else cast(o_custkey as int) end as menciones,
  o_orderstatus = 'F' as titulo_flag, null::varchar as region from orders join customer on o_custkey = c_custkey
  where o_orderpriority <> '5-LOW'""")
def media_mentions(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    raw = rows.select(
        F.when(F.col("o_orderpriority") != "5-LOW", _text("o_orderkey")).otherwise(" ").alias("article_id"),
        F.concat(F.lit(" "), "c_mktsegment").alias("candidato"), F.concat("o_orderpriority", F.lit(" ")).alias("medio"),
        shown(F.col("o_orderdate").cast("timestamp")).alias("fecha"),
        F.when(F.col("o_orderstatus") != "P", F.concat(_text("o_custkey"), F.lit(".0"))).alias("menciones"),
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "0").alias("titulo_flag"),
        F.lit("nan").alias("region"))
    return media.mentions(raw).select("article_id", "candidato", "medio", "fecha", "menciones", "titulo_flag", "region")


@query("""select cast(o_orderkey as varchar) as article_id, c_mktsegment as candidato, cast(o_orderdate as date) as fecha,
  case when o_orderstatus = 'P' then null else cast(o_custkey % 100 as double) + 0.25 end as porcentaje,
  o_orderpriority as encuestadora from orders join customer on o_custkey = c_custkey""")
def media_vote_intentions(t: Tables) -> DataFrame:
    raw = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        _text("o_orderkey").alias("article_id"), F.col("c_mktsegment").alias("candidato"), F.lit("m").alias("medio"),
        _text("o_orderdate").alias("fecha"),
        F.when(F.col("o_orderstatus") != "P", F.concat((F.col("o_custkey") % 100).cast("string"), F.lit(".25"))).alias(
            "porcentaje"), F.col("o_orderpriority").alias("encuestadora"))
    return media.vote_intentions(raw).select("article_id", "candidato", "fecha",
                                             F.col("porcentaje").cast("double").alias("porcentaje"), "encuestadora")


V_VOICE = """days as (select fecha, count(*) as n from (select distinct fecha, medio from mentions) group by 1),
l as (select fecha, medio, candidato, menciones, menciones / 100.0::double as share_of_voice from mentions
  where medio <> '5-LOW'),
r as (select fecha, medio, candidato, menciones + 1000 as menciones, null::double as share_of_voice,
  round(menciones / 7.0::double, 4) as rolling_7, menciones - 2.0::double as momentum from mentions where medio <> '1-URGENT')"""


def _voice_export(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.mentions().withColumn("fecha", _text("fecha"))
    left = rows.where(F.col("medio") != "5-LOW").select(
        "fecha", "medio", "candidato", _text("menciones").alias("menciones"),
        (F.col("menciones") / 100).cast("string").alias("share_of_voice"), F.lit(2).cast("bigint").alias("file_order"))
    stale = left.withColumns({"menciones": F.lit("0"), "file_order": F.lit(1).cast("bigint")})
    right = rows.where(F.col("medio") != "1-URGENT").select(
        "fecha", "medio", "candidato", (F.col("menciones") + 1000).cast("string").alias("menciones"),
        F.lit("").alias("share_of_voice"), F.round(F.col("menciones") / 7, 4).cast("string").alias("rolling_7"),
        (F.col("menciones") - 2).cast("double").cast("string").alias("momentum"), F.lit(1).cast("bigint").alias("file_order"))
    return stale.unionByName(left), right


@query(ctes(V_MENTIONS, V_VOICE) + """select coalesce(l.fecha, r.fecha) as fecha, coalesce(l.medio, r.medio) as medio,
  coalesce(l.candidato, r.candidato) as candidato,
  cast(case when l.fecha is not null then l.menciones else r.menciones end as int) as menciones,
  case when l.fecha is not null then l.share_of_voice end as share_of_voice, rolling_7, momentum
  from l full join r on l.fecha = r.fecha and l.medio = r.medio and l.candidato = r.candidato""")
def share_of_voice_merge(t: Tables) -> DataFrame:
    out = media.share_of_voice(*_voice_export(t))
    return out.withColumns({c: F.col(c).cast("double") for c in ("share_of_voice", "rolling_7", "momentum")})


@query(ctes(V_MENTIONS, V_VOICE) + """select fecha, medio, candidato, cast(menciones as int) as menciones, rolling_7,
  momentum from r""")
def media_momentum(t: Tables) -> DataFrame:
    out = media.momentum(_voice_export(t)[1])
    return out.select("fecha", "medio", "candidato", "menciones", F.col("rolling_7").cast("double").alias("rolling_7"),
                      F.col("momentum").cast("double").alias("momentum"))


@query("""select tabla, filas from (select 'mentions' as tabla, count(*) as filas from orders
  union all select 'vote_intentions', count(*) from orders where o_orderstatus <> 'P')""")
def media_table_counts(t: Tables) -> DataFrame:
    """Media tables written as CSV, loaded by the media job, counted per table."""
    lake = jobs.Lake(t.spark, new_work_path(t.spark, "media"))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    raw = rows.select(_text("o_orderkey").alias("article_id"), F.col("o_orderpriority").alias("medio"),
                      _text("o_orderdate").alias("fecha"), F.col("c_mktsegment").alias("candidato"), "o_orderstatus")
    # Every article twice: the job keeps one row per key.
    tables.write_csv(raw.drop("o_orderstatus").unionByName(raw.drop("o_orderstatus")), f"{lake.root}/in/mentions")
    tables.write_csv(raw.where(F.col("o_orderstatus") != "P").drop("o_orderstatus"), f"{lake.root}/in/votes")
    return jobs.run_media(lake, mentions=f"{lake.root}/in/mentions", votes=f"{lake.root}/in/votes")


@query(ctes("""v as (select *, page_id as n from pages)""") + """select cast(page_id as varchar) as video_id, url as title,
  case when page_id % 7 = 0 then null else page_id * 1000 end as view_count, cast(page_id % 600 as int) as duration,
  '2024-01-05 10:00:00' as published_at, null::varchar as tags from v where page_id % 11 <> 0""")
def youtube_videos(t: Tables) -> DataFrame:
    n = F.col("page_id")
    raw = t.pages.select(
        F.when(n % 11 == 0, F.lit("nan")).otherwise(_text("page_id")).alias("video_id"), F.col("url").alias("title"),
        F.when(n % 7 == 0, F.lit("nan")).otherwise(F.concat(_text("page_id"), F.lit("000.0"))).alias("view_count"),
        (n % 600).cast("string").alias("duration"), F.lit("2024-01-05T10:00:00Z").alias("published_at"),
        F.lit(" ").alias("tags"))
    good, _ = media.youtube_videos(raw, "r1")
    return good.select("video_id", "title", "view_count", "duration", shown("published_at").alias("published_at"), "tags")


@query("""select cast(page_id as varchar) as video_id, case when page_id % 2 = 0 then url else 'respaldo' end as description,
  page_id as play_count, '2024-01-05 10:00:00' as create_time from pages""")
def tiktok_videos(t: Tables) -> DataFrame:
    raw = t.pages.select(
        _text("page_id").alias("video_id"), F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise("").alias("desc"),
        F.lit("respaldo").alias("description"), _text("page_id").alias("play_count"),
        F.lit("2024-01-05 10:00:00").alias("create_time"))
    good, _ = media.tiktok_videos(raw, "r1")
    return good.select("video_id", "description", "play_count", shown("create_time").alias("create_time"))


@query("""select case when page_id % 11 = 0 then 'sin id' else 'cargados' end as grupo, count(*) as filas from pages
  group by 1""")
def video_load_counts(t: Tables) -> DataFrame:
    raw = t.pages.select(F.when(F.col("page_id") % 11 != 0, _text("page_id")).alias("video_id"))
    good, bad = media.youtube_videos(raw, "r1")
    part = lambda name, df: df.select(F.lit(name).alias("grupo"))
    return part("cargados", good).unionByName(part("sin id", bad)).groupBy("grupo").agg(F.count(F.lit(1)).alias("filas"))


# --- files, stored tables, jobs and the stream ------------------------------------------------------------------------

# Input bytes that one exported file stands for at most.
EXPORT_BYTES = 32 << 20


def _write_exports(df: DataFrame, path: str, files_wanted: int = 8, more: bool = True, compression: str = "none") -> int:
    """Exported files as a scraper would leave them: so many, or with ``more`` as many as keep each one small. Returns their number."""
    if more:
        found = [files.hadoop_path(df.sparkSession, unquote(f)) for f in df.inputFiles()]
        files_wanted = max(files_wanted, -(-sum(fs.getFileStatus(p).getLen() for fs, p in found) // EXPORT_BYTES))
    (df.repartition(files_wanted).write.option("header", "true").option("escape", '"').option("quoteAll", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").option("compression", compression).csv(path))
    return files_wanted


@query(ctes(V_POSTS) + """select cast(seq as varchar) || '.0' as id, md5(text) as content_md5, cast(likes as varchar) as likes
  from posts""")
def csv_scan(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "csv")
    _write_exports(twitter_export(t), path)
    return files.read_csv(t.spark, path, schemas.TWITTER_CSV).select("id", F.md5("content").alias("content_md5"), "likes")


@query(ctes(V_POSTS) + """select cast(seq as varchar) || '.0' as id, md5(text) as content_md5,
    case when lang = 'fr' then null else cast(likes as varchar) end as likes from posts""")
def csv_scan_of_unlike_headers(t: Tables) -> DataFrame:
    """Exports whose columns stand in other orders, in other case, or are missing, read together."""
    path, rows = new_work_path(t.spark, "csv"), twitter_export(t).withColumn("lang", F.substring("Query", 3, 9))
    columns = schemas.TWITTER_CSV
    layouts = {"en": columns, "de": columns[::-1], "es": [c.upper() for c in columns], "fr": [c for c in columns[::2] + columns[1::2] if c != "likes"]}
    for lang, names in layouts.items():
        _write_exports(rows.where(F.col("lang") == lang).select(*names), f"{path}/{lang}", 2)
    return files.read_csv(t.spark, f"{path}/*", columns).select("id", F.md5("content").alias("content_md5"), "likes")


@query(ctes(V_POSTS) + f"""select case when lang = 'en' then 'ext_' || seq end as id, md5({TEXT}) as text_md5, {_AT} as datetime_utc,
  case when lang <> 'es' then username end as username from posts""")
def external_exports_of_unlike_headers(t: Tables) -> DataFrame:
    """Generic exports that name their columns in other words, read together; only one has ids."""
    path = new_work_path(t.spark, "external")
    rows = t.posts().select(_text("seq").alias("id"), "text", shown("datetime_utc").alias("date"), "username", "lang")
    layouts = {"en": ["id", "text", "date", "username"], "es": ["fecha", "mensaje"], "": ["usuario", "datetime", "content"]}
    for lang, names in layouts.items():
        own = rows.where(F.col("lang") == lang if lang else ~F.col("lang").isin("en", "es"))
        for name, column in {"fecha": "date", "mensaje": "text", "usuario": "username", "datetime": "date", "content": "text"}.items():
            own = own.withColumn(name, F.col(column))
        _write_exports(own.select(*names), f"{path}/{lang or 'other'}", 2)
    good, _ = mappers.map_posts(files.read_csv(t.spark, f"{path}/*"), "external")
    known = F.col("id").rlike("^ext_[0-9]+$") & (F.length("id") < 15)
    return good.select(F.when(known, F.col("id")).alias("id"), F.md5("text").alias("text_md5"), "datetime_utc", "username")


@query(ctes(V_POSTS) + f"""select md5({TEXT}) as text_md5, 2 * count(*) as filas, 2 * count(*) as ids from posts group by 1""")
def external_export_without_ids(t: Tables) -> DataFrame:
    """A generic export without ids that holds every row twice: each row keeps its place and gets an id of its own."""
    path = new_work_path(t.spark, "external")
    rows = t.posts().select(F.col("text").alias("mensaje"), shown("datetime_utc").alias("fecha"))
    _write_exports(rows.unionByName(rows), path, 4)
    good, _ = mappers.map_posts(files.read_csv(t.spark, path), "external")
    return good.groupBy(F.md5("text").alias("text_md5")).agg(
        F.count(F.lit(1)).alias("filas"), F.count_distinct("id").alias("ids"))


@query(ctes(V_POSTS) + """select source, count(*) as filas, min(seq) as primera, max(seq) as ultima from posts
  where source <> 'other' group by 1""")
def jsonl_store_and_scan(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "bronze")
    rows = t.posts().select(*[f.name for f in schemas.BRONZE_POST.fields if f.name not in ("ingested_at", "datetime_utc")],
                            shown("datetime_utc").alias("datetime_utc"), as_of().alias("ingested_at"))
    tables.append_jsonl(rows, path, AS_OF[:10])
    stored = files.read_bronze_jsonl(t.spark, path, date=AS_OF[:10]).where(F.col("source") != "other")
    n = F.col("source_id").cast("bigint")
    return stored.groupBy("source").agg(F.count(F.lit(1)).alias("filas"), F.min(n).alias("primera"), F.max(n).alias("ultima"))


@query("""select o_orderpriority || '.csv' as original_filename,
  o_orderkey - min(o_orderkey) over (partition by o_orderpriority) + 1 as row_number, o_orderstatus,
  case when o_orderstatus = 'P' then null else cast(o_custkey as varchar) end as cliente from orders""")
def landing_rows(t: Tables) -> DataFrame:
    blank = F.when(F.col("o_orderstatus") == "P", "").otherwise(_text("o_custkey"))
    raw = t.orders.select("o_orderstatus", blank.alias("cliente"),
                          F.concat(F.lit("file:/in/"), "o_orderpriority", F.lit(".csv")).alias("file_path"),
                          F.col("o_orderkey").alias("file_order"))
    rows = files.landing_rows(raw, "r1", "twitter")
    got = lambda k: F.get_json_object("payload", f"$.{k}").alias(k)
    return rows.select("original_filename", "row_number", got("o_orderstatus"), got("cliente"))


@query("""with u as (select o_custkey, o_orderkey, case o_orderstatus when 'O' then 1 when 'P' then 2 else 3 end as v from orders)
select o_custkey, max_by(o_orderkey, v * 1000000000::bigint + o_orderkey) as o_orderkey, cast(count(distinct v) as int) as n from u
group by 1""")
def compacted_twice(t: Tables) -> DataFrame:
    """Three batches with a compaction after the first and the second; the second is then repeated; runs stay apart."""
    schema = schemas.T.StructType([schemas.T.StructField("o_custkey", schemas.L), schemas.T.StructField("o_orderkey", schemas.L)])
    table = tables.VersionedTable(t.spark, new_work_path(t.spark, "compacted"), schema, ["o_custkey"])
    batch = lambda s: dd.dedupe(t.orders.where(F.col("o_orderstatus") == s).select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"])
    parts = {1: batch("O"), 2: batch("P"), 3: batch("F")}
    for seq, rows in parts.items():
        table.write(rows, seq, f"r{seq}")
        if seq < 3:
            table.compact(10 * seq)
    table.write(parts[2], 99, "r2")
    n = parts[1].union(parts[2]).union(parts[3]).groupBy("o_custkey").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return table.latest().join(n, "o_custkey")


@query("""select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by v desc,
    case when v = 1 then o_orderkey else -o_orderkey end) as k from (select o_custkey, o_orderkey, 1 as v from orders
    union all select o_custkey, o_orderkey, 2 from orders where o_orderstatus = 'F')) where k = 1""")
def keyed_upsert(t: Tables) -> DataFrame:
    """Two batches into one table, the second repeated as after a failure, then compacted."""
    schema = schemas.T.StructType([schemas.T.StructField("o_custkey", schemas.L), schemas.T.StructField("o_orderkey", schemas.L)])
    table = tables.VersionedTable(t.spark, new_work_path(t.spark, "upsert"), schema, ["o_custkey"])
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    table.write(dd.dedupe(rows, ["o_custkey"], ["o_orderkey"], keep="first"), 1, "a")
    newer = dd.dedupe(rows.where(F.col("o_orderstatus") == "F"), ["o_custkey"], ["o_orderkey"], keep="last")
    for _ in range(2):
        table.write(newer, 2, "b")
    table.compact(3)
    return table.latest()


@query(ctes(V_POSTS) + """select source, '2024-01-31' as day, source || '_comments.csv' as name, count(*) as filas
  from posts where source <> 'other' group by 1, 2, 3""")
def inbox_paths(t: Tables) -> DataFrame:
    path = F.concat(F.lit("file:/inbox/"), "source", F.lit("/2024-01-31/"), "source", F.lit("_comments.csv"))
    rows = t.posts().select(files.parse_inbox_path(path).alias("p")).where(F.col("p").isNotNull())
    return rows.groupBy("p.source", "p.day", "p.name").agg(F.count(F.lit(1)).alias("filas"))


@query(ctes(V_POSTS) + """select 'e2e' as flow_name, 'success' as status, (select count(*) from posts) as rows_out,
    'PASS' as overall, 1 as n
  union all select 'e2e', 'success', 0, null, 1""")
def batch_job_ledger(t: Tables) -> DataFrame:
    """The whole batch job over exported files, then again over the same files, which adds nothing."""
    lake = jobs.Lake(t.spark, new_work_path(t.spark, "lake"))
    exports = f"{lake.root}/exports"
    _write_exports(twitter_export(t), exports)
    for _ in range(2):
        jobs.run_batch(lake, f"{exports}/*.csv", "twitter", skip_gold=False, as_of=as_of())
    runs = lake.ledger().runs()
    verdict = F.try_element_at("quality_summary", F.lit("overall")).alias("overall")
    return runs.groupBy("flow_name", "status", "rows_out", verdict).agg(F.count(F.lit(1)).cast("int").alias("n"))


_FIRST_OF_BATCHES = f"""select 'tw_' || seq as id, md5({clean_sql('text')}) as clean_md5, {mask_sql('text')} <> text
  as pii_detected, likes from posts"""


@query(ctes(V_POSTS) + _FIRST_OF_BATCHES)
def inbox_stream_to_silver(t: Tables) -> DataFrame:
    """Exported files picked up by the inbox stream; a second start from the same checkpoint adds nothing."""
    lake = jobs.Lake(t.spark, new_work_path(t.spark, "stream"))
    n = _write_exports(twitter_export(t), f"{lake.root}/inbox/twitter/{AS_OF[:10]}", 4)
    for _ in range(2):
        inbox.stream_posts(lake, f"{lake.root}/inbox", "twitter", f"{lake.root}/checkpoint",
                           files_per_trigger=-(-n // 2)).awaitTermination()
    return lake.silver().latest().select("id", F.md5("text_clean").alias("clean_md5"), "pii_detected",
                                         F.col("engagement")["likes"].alias("likes"))


@query(ctes(V_POSTS) + _FIRST_OF_BATCHES)
def two_inboxes_into_one_lake(t: Tables) -> DataFrame:
    """Two streams of one source, each with its own inbox and checkpoint: neither takes the other's place."""
    lake = jobs.Lake(t.spark, new_work_path(t.spark, "inboxes"))
    rows = twitter_export(t)
    odd = F.col("id").cast("double").cast("bigint") % 2 == 1
    for name, part in (("a", rows.where(odd)), ("b", rows.where(~odd))):
        _write_exports(part, f"{lake.root}/{name}/twitter/{AS_OF[:10]}", 2)
        inbox.stream_posts(lake, f"{lake.root}/{name}", "twitter", f"{lake.root}/checkpoint-{name}").awaitTermination()
    return lake.silver().latest().select("id", F.md5("text_clean").alias("clean_md5"), "pii_detected",
                                         F.col("engagement")["likes"].alias("likes"))


@query(ctes(V_POSTS) + """select cast(seq as varchar) as video_id, likes as view_count from posts""")
def inbox_stream_to_videos(t: Tables) -> DataFrame:
    """Video files beside comment files: only the former reach the video table, a later file refreshing a video."""
    lake = jobs.Lake(t.spark, new_work_path(t.spark, "videos"))
    rows = t.posts().select(_text("seq").alias("video_id"), *[
        (_text("likes") if c == "view_count" else F.lit("")).alias(c) for c in schemas.YOUTUBE_VIDEO_CSV[1:]])
    stage = f"{lake.root}/stage"
    old = rows.withColumn("view_count", F.lit("1"))
    for name, df in (("a", old), ("b", rows)):
        _write_exports(df, f"{stage}/{name}", 1, more=False)
        rename_only_csv(t, f"{stage}/{name}", f"{lake.root}/inbox/youtube/{AS_OF[:10]}", f"run_{name}_videos.csv")
        inbox.stream_videos(lake, f"{lake.root}/inbox", "youtube", f"{lake.root}/checkpoint").awaitTermination()
    return lake.videos("youtube").latest().select("video_id", "view_count")


def rename_only_csv(t: Tables, folder: str, target: str, name: str) -> None:
    """Move the one file of a folder into the inbox under its final name, as a writer should."""
    fs, source = files.hadoop_path(t.spark, f"{folder}/*.csv")
    _, goal = files.hadoop_path(t.spark, target)
    fs.mkdirs(goal)
    for status in fs.globStatus(source):
        fs.rename(status.getPath(), files.hadoop_path(t.spark, f"{target}/{name}")[1])


@query(ctes(V_POSTS) + "select source_id as id, likes, retweets from posts")
def stream_upsert(t: Tables) -> DataFrame:
    """Rows streamed from Parquet files into a keyed table."""
    root = new_work_path(t.spark, "upserts")
    t.posts().select(F.col("source_id").alias("id"), "likes", "retweets").repartition(4).write.parquet(f"{root}/in")
    schema = schemas.T.StructType([schemas.T.StructField("id", schemas.S), schemas.T.StructField("likes", schemas.L),
                                   schemas.T.StructField("retweets", schemas.L)])
    table = tables.VersionedTable(t.spark, f"{root}/table", schema, ["id"])
    rows = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    inbox.stream_upsert(rows, table, f"{root}/checkpoint", ["likes"]).awaitTermination()
    return table.latest()
