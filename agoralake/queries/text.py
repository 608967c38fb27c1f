"""Queries over text, casts, calendar and scoring expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agoralake import schemas
from agoralake.functions import casting, pii, scoring, text, timefn
from agoralake.operators import entities, quality
from agoralake.plans import layers, scorers
from agoralake.queries.registry import V_OPINIONS, V_POSTS, V_RUNS, Tables, ctes, query, scale, shown
from agoralake.session import stored

# Stand-in dictionaries over words that occur in the documents.
ALIASES = {
    "thing": "Alfa Uno", "by the": "Alfa Uno", "ering": "Beta Dos", "oning": "Gama Tres", "nicht": "Delta Cuatro",
    "eine": "Delta Cuatro", "para": "Epsilon Cinco", "de la": "Epsilon Cinco",
}
PARTY_ALIASES = {"reing": "Partido Norte", "para": "Partido Sur", "und die": "Partido Este"}
PARTY_OF = {"Alfa Uno": "Partido Norte", "Beta Dos": "Partido Oeste", "Delta Cuatro": "Partido Este"}
TARGETS = {"ering": "Beta Dos", "oning": "Gama Tres", "thing": "Alfa Uno", "tionen": "Delta Cuatro",
           "entreau": "Epsilon Cinco"}
PHRASES = ["of the", "in der", "de la", "le la", "by the"]
REPORTING = ["nicht", "pour", "with"]
POSITIVE = ["the", "la", "die", "of", "le", "by"]
NEGATIVE = ["and", "und", "et", "el", "de", "in"]
DICTIONARIES = {"aliases": ALIASES, "party_aliases": PARTY_ALIASES, "party_of": PARTY_OF, "fuzzy_targets": TARGETS}

# --- oracle fragments -------------------------------------------------------------------------------------------------

# Patterns of the SQL, written out here so that a wrong pattern of the package shows.
S = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
W = r"\p{L}\p{N}_"
URL = rf"(?i)https?://[^{S}]+|www\.[^{S}]+"
EMOJI = (r"[\x{1F1E0}-\x{1F1FF}\x{1F300}-\x{1F5FF}\x{1F600}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F900}-\x{1FAFF}"
         r"\x{2700}-\x{27BF}]")
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = rf"(?:\+57[{S}]?)?(?:\(?\p{{Nd}}{{1,3}}\)?[{S}.-]?)?\p{{Nd}}{{3}}[{S}.-]?\p{{Nd}}{{4}}"
SPANISH = ("de la el en los las un una por con para que del al se es no su más pero colombia país gobierno presidente "
           "candidato").split()
_CLEAN = (
    f"trim(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace({{x}}, '{URL}', '', 'g'), "
    f"'@[{W}]+', '', 'g'), '#[{W}]+', '', 'g')), '[{S}]+', ' ', 'g'))"
)
_NORM = (
    f"trim(regexp_replace(regexp_replace(translate(regexp_replace(lower({{x}}), 'http[^{S}]+|[@#]', '', 'g'), "
    f"'áéíóúàèìòùüñ', 'aeiouaeiouun'), '([aeiou])\\x{{{{301}}}}', '\\1', 'g'), '[^{W}]+', ' ', 'g'))"
)
_MASK = (
    f"regexp_replace(regexp_replace({{x}}, '{EMAIL}', '[EMAIL]', 'g'), "
    f"'{PHONE.replace('{', '{{').replace('}', '}}')}', '[PHONE]', 'g')"
)


def clean_sql(x: str) -> str:
    return _CLEAN.replace("{x}", x)


def norm_sql(x: str) -> str:
    return _NORM.replace("{x}", x).replace("{{", "{").replace("}}", "}")


def mask_sql(x: str) -> str:
    return _MASK.replace("{x}", x).replace("{{", "{").replace("}}", "}")


def _values(pairs: dict[str, str], a: str, b: str, name: str) -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in pairs.items())
    return f"{name}({a}, {b}) as (select * from (values {rows}) as t({a}, {b}))"


V_NORM = "norm as (select *, " + norm_sql("text") + " as t from posts)"
V_ALIAS_HITS = (
    _values(ALIASES, "alias", "entity", "aliases")
    + ",\nalias_hits as (select distinct seq, entity from norm, aliases"
      " where contains(' ' || t || ' ', ' ' || alias || ' '))"
)
# Longest common subsequence of every distinct long token and target, cell by cell.
V_FUZZY = (
    _values(TARGETS, "target", "entity", "fuzzy_targets") + """,
tokens as (select distinct seq, unnest(string_split(t, ' ')) as token from norm),
pairs as (select token, target, entity, r as target_rank from (select distinct token from tokens where length(token) >= 5),
            (select *, row_number() over () as r from fuzzy_targets)
          where 200.0 * least(length(token), length(target)) / (length(token) + length(target)) >= 85),
lcs(token, target, i, j, prev, cur) as (
  select token, target, 1, 0, list_transform(range(length(target) + 1), lambda x: 0), [0] from pairs
  union all
  select token, target, case when j = length(target) then i + 1 else i end,
         case when j = length(target) then 0 else j + 1 end,
         case when j = length(target) then cur else prev end,
         case when j = length(target) then [0]
              else list_append(cur, case when substr(token, i, 1) = substr(target, j + 1, 1) then prev[j + 1] + 1
                                         else greatest(prev[j + 2], cur[j + 1]) end) end
  from lcs where i <= length(token)),
ratios as (select token, target, 200.0 * cur[-1] / (length(token) + length(target)) as ratio
           from lcs where i = length(token) and j = length(target)),
best as (select token, entity, ratio from (
    select r.*, p.entity, row_number() over (partition by r.token order by ratio desc, target_rank) as k
    from ratios r join pairs p on p.token = r.token and p.target = r.target) where k = 1 and ratio >= 85),
fuzzy_hits as (select distinct seq, entity from tokens join best using (token))"""
)
V_CANDIDATES = "cands as (select seq, entity from alias_hits union select seq, entity from fuzzy_hits)"
V_PARTIES = (
    _values(PARTY_ALIASES, "alias", "party", "party_aliases") + ",\n" + _values(PARTY_OF, "cand", "party", "party_of")
    + """,
parties as (
  select distinct seq, party from norm, party_aliases where contains(' ' || t || ' ', ' ' || alias || ' ')
  union select seq, party from cands join party_of on cand = entity)"""
)
V_ENTITIES = ",\n".join([V_POSTS, V_NORM, V_ALIAS_HITS, V_FUZZY, V_CANDIDATES, V_PARTIES])


def _or_pattern(words: list[str]) -> str:
    return "(^| )(" + "|".join(words) + ")( |$)"


def normalised_posts(t: Tables) -> DataFrame:
    return t.posts().withColumn("t", text.analysis_text(F.col("text")))


# --- cleaning ---------------------------------------------------------------------------------------------------------

@query(ctes(V_POSTS) + f"""select id, md5({clean_sql('text')}) as text_clean_md5, length({clean_sql('text')}) as n,
  regexp_matches(text, '#[{W}]+') as has_hashtags, regexp_matches(text, '{EMOJI}') as has_emojis,
  regexp_matches(text, '{URL}') as has_urls_original from posts""")
def text_normalise(t: Tables) -> DataFrame:
    rows = t.posts().select("id", text.normalized(F.col("text")).alias("n")).select("id", "n.*")
    return rows.select("id", F.md5("text_clean").alias("text_clean_md5"), F.length("text_clean").alias("n"),
                       "has_hashtags", "has_emojis", "has_urls_original")


@query(f"""select page_id, md5(regexp_replace(html, '{URL}', '', 'g')) as left_md5,
  regexp_matches(html, '{URL}') as has_url from pages""")
def strip_urls_of_pages(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(text.strip_urls(F.col("html"))).alias("left_md5"),
                          text.has_url(F.col("html")).alias("has_url"))


@query(f"""select page_id, md5(regexp_replace(regexp_replace(html, '@[{W}]+', '', 'g'), '#[{W}]+', '', 'g')) as left_md5,
  regexp_matches(html, '#[{W}]+') as has_hashtag from pages""")
def strip_signs_of_pages(t: Tables) -> DataFrame:
    html = F.col("html")
    return t.pages.select("page_id", F.md5(text.strip_hashtags(text.strip_mentions(html))).alias("left_md5"),
                          text.has_hashtag(html).alias("has_hashtag"))


_ES = "[" + ", ".join(f"'{w}'" for w in SPANISH) + "]"
_LANG = f"""words as (select id, text, list_filter(list_distinct(regexp_split_to_array(lower(text), '[{S}]+')), lambda x: x <> '')
    as w from posts),
langs as (select id, case when length(regexp_replace(text, '^[{S}]+|[{S}]+$', '', 'g')) < 3 then null
    when len(list_filter(w, lambda x: list_contains({_ES}, x))) >= 1
     and len(list_filter(w, lambda x: list_contains({_ES}, x))) / len(w) >= 0.10 then 'es' else 'unknown' end as lang
  from words)"""


@query(ctes(V_POSTS, _LANG) + "select id, lang from langs")
def detect_spanish(t: Tables) -> DataFrame:
    return t.posts().select("id", text.detect_spanish(F.col("text")).alias("lang"))


@query(ctes(V_POSTS, _LANG) + """select l.id, case when l.lang = 'unknown' and length(p.text) > 500 then 'long'
  when l.lang = 'unknown' then 'short' else l.lang end as lang from langs l join posts p on p.id = l.id""")
def language_fallback(t: Tables) -> DataFrame:
    rows = t.posts().select("id", "text", text.detect_spanish(F.col("text")).alias("lang"))
    by_size = lambda value: "long" if len(value) > 500 else "short"
    return layers.with_language_fallback(rows, "text", detector=by_size).select("id", "lang")


@query(ctes(V_POSTS) + f"""select id, md5({mask_sql('text')}) as masked_md5, {mask_sql('text')} <> text as pii_detected,
  concat_ws(',', case when regexp_matches(text, '{EMAIL}') then 'email' end,
    case when regexp_matches(regexp_replace(text, '{EMAIL}', '[EMAIL]', 'g'), '{PHONE}') then 'phone' end)
  as pii_types from posts""")
def pii_mask(t: Tables) -> DataFrame:
    rows = pii.with_masking(t.posts().select("id", "text"), "text")
    return rows.select("id", F.md5("text").alias("masked_md5"), "pii_detected",
                       F.concat_ws(",", "pii_types").alias("pii_types"))


@query(ctes(V_POSTS) + f"""select source, count(*) as total,
  count(*) filter (where {mask_sql('text')} <> text) as con_pii from posts group by 1""")
def pii_counts(t: Tables) -> DataFrame:
    rows = pii.with_masking(t.posts().select("source", "text"), "text")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("total"), F.count_if("pii_detected").alias("con_pii"))


@query("select doc_id, md5(text) as repaired_md5, md5(text) as kept_md5 from documents")
def mojibake_repair(t: Tables) -> DataFrame:
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return t.documents.select("doc_id", F.md5(text.repair_mojibake(broken)).alias("repaired_md5"),
                              F.md5(text.repair_mojibake(F.col("text"))).alias("kept_md5"))


@query(ctes(V_POSTS) + f"select id, md5({norm_sql('text')}) as norm_md5 from posts")
def analysis_normalise(t: Tables) -> DataFrame:
    return t.posts().select("id", F.md5(text.analysis_text(F.col("text"))).alias("norm_md5"))


@query(ctes(V_POSTS) + f"""select id, case when {clean_sql('text')} = '' then 0
  else len(string_split({clean_sql('text')}, ' ')) end as word_count, length({clean_sql('text')}) as char_count
  from posts""")
def word_and_char_counts(t: Tables) -> DataFrame:
    rows = t.posts().select("id", text.clean_text(F.col("text")).alias("c"))
    return rows.select("id", text.word_count(F.col("c")).alias("word_count"), text.char_count(F.col("c")).alias("char_count"))


@query(ctes(V_POSTS) + """select id, 'Nota ' || outlet || ' ' || lang as contexto,
  md5(trim(text || ' Nota ' || outlet || ' ' || lang)) as texto_md5 from posts""")
def context_text(t: Tables) -> DataFrame:
    rows = t.posts().withColumn("contexto", text.context_text(F.col("metadata")))
    return rows.select("id", "contexto",
                       F.md5(F.trim(text.with_context(F.col("text"), F.col("contexto")))).alias("texto_md5"))


# --- entities ---------------------------------------------------------------------------------------------------------

@query(ctes(V_POSTS, V_NORM, V_ALIAS_HITS) + "select seq, entity from alias_hits")
def alias_entities(t: Tables) -> DataFrame:
    return normalised_posts(t).select("seq", F.explode(entities.alias_entities(F.col("t"), ALIASES)).alias("entity"))


@query(ctes(V_POSTS, V_NORM, """terms as (select distinct alias, alias as entity from (
    select lower(r_name) as alias from region union all select lower(n_name) from nation
    union all select item from (select distinct substr(t, 1, instr(t || ' ', ' ') - 1) || ' '
      || split_part(t, ' ', 2) as item from norm where contains(t, ' '))))""") +
       "select distinct seq, entity from norm, terms where contains(' ' || t || ' ', ' ' || alias || ' ')")
def alias_join_large_dictionary(t: Tables) -> DataFrame:
    """Every opening word pair of a post is a term: a dictionary that grows with the data, so it is joined."""
    posts = stored(normalised_posts(t).select("seq", "t"), "alias-posts")  # else they are joined and normalised once more for the terms
    pairs = posts.where(F.contains("t", F.lit(" "))).select(
        F.concat_ws(" ", F.split_part("t", F.lit(" "), F.lit(1)), F.split_part("t", F.lit(" "), F.lit(2))).alias("alias"))
    names = t.region.select(F.lower("r_name").alias("alias")).unionByName(t.nation.select(F.lower("n_name").alias("alias")))
    terms = stored(pairs.unionByName(names).distinct().withColumn("entity", F.col("alias")), "alias-terms")
    return entities.alias_entities_by_join(posts, "seq", "t", terms)


@query(ctes(V_POSTS, V_NORM, V_FUZZY) + "select seq, entity from fuzzy_hits")
def fuzzy_tokens(t: Tables) -> DataFrame:
    return entities.fuzzy_entities(normalised_posts(t), "seq", "t", TARGETS)


@query(ctes(V_POSTS, V_NORM, V_FUZZY) + "select seq, entity from fuzzy_hits")
def fuzzy_tokens_in_row(t: Tables) -> DataFrame:
    return normalised_posts(t).select("seq", F.explode(entities.fuzzy_in_row(F.col("t"), TARGETS)).alias("entity"))


@query(ctes(V_POSTS, V_NORM, V_FUZZY) + "select token, entity, round(ratio, 6) as ratio from best")
def fuzzy_vocabulary(t: Tables) -> DataFrame:
    tokens = entities.post_tokens(normalised_posts(t), "seq", "t").select("token").distinct()
    return scale(entities.close_targets(tokens, TARGETS))


@query(ctes(V_ENTITIES) + """select n.seq,
  (select string_agg(entity, '|' order by entity) from cands c where c.seq = n.seq) as candidatos,
  (select string_agg(party, '|' order by party) from parties p where p.seq = n.seq) as partidos from norm n""")
def entities_and_parties(t: Tables) -> DataFrame:
    rows = entities.with_entities(normalised_posts(t).select("seq", "t"), "t", **DICTIONARIES)
    joined = lambda c: F.nullif(F.array_join(c, "|"), F.lit("")).alias(c)
    return rows.select("seq", joined("candidatos"), joined("partidos"))


_INTENT = f"""case when regexp_matches(t, '{_or_pattern(REPORTING)}') then 0
    when regexp_matches(t, '{_or_pattern(PHRASES)}') then 1 else 0 end"""


@query(ctes(V_POSTS, V_NORM) + f"select seq, {_INTENT} as intencion from norm")
def stated_intention(t: Tables) -> DataFrame:
    return t.posts().select("seq", entities.stated_intention(F.col("text"), PHRASES, REPORTING).alias("intencion"))


@query(ctes(V_POSTS, V_NORM) + f"""select count(*) as total, cast(sum({_INTENT}) as bigint) as con_intencion,
  round(avg({_INTENT}) * 100, 6) as porcentaje from norm""")
def intention_share(t: Tables) -> DataFrame:
    flagged = t.posts().select(
        entities.stated_intention(F.col("text"), PHRASES, REPORTING).alias("intencion_explicita"))
    return scale(layers.intention_share(flagged))


# --- slugs, counts, links, names --------------------------------------------------------------------------------------

@query("""select n_nationkey, substr(string_split(trim(n_name), ' ')[1], 1, 15) as corto,
  substr(regexp_replace(trim(r_name || ' ' || n_name || ' ' || n_name), '\\s+', '_', 'g'), 1, 20) as largo,
  'ENC_' || substr(string_split(trim(n_name), ' ')[1], 1, 15) as columna
  from nation join region on n_regionkey = r_regionkey""")
def slugs(t: Tables) -> DataFrame:
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    short = text.first_name_slug(F.col("n_name"), 15)
    return rows.select("n_nationkey", short.alias("corto"),
                       text.underscore_slug(F.concat_ws(" ", "r_name", "n_name", "n_name"), 20).alias("largo"),
                       F.concat(F.lit("ENC_"), short).alias("columna"))


@query("""select l_linenumber, l_returnflag, count(*) as n, cast(sum(case l_returnflag
    when 'A' then trunc(cast(l_partkey || '.' || l_linenumber as double) * 1000) when 'N' then l_suppkey * 1000000 else l_partkey * 1000 + 7 end)
  as bigint) as total from lineitem group by 1, 2""")
def social_counts(t: Tables) -> DataFrame:
    part, supp, line = (F.col(c).cast("string") for c in ("l_partkey", "l_suppkey", "l_linenumber"))
    shown_count = (F.when(F.col("l_returnflag") == "A", F.concat(part, F.lit("."), line, F.lit("K")))
                   .when(F.col("l_returnflag") == "N", F.concat(supp, F.lit(" m")))
                   .otherwise(F.concat(part, F.lit(",007"))))
    return t.lineitem.groupBy("l_linenumber", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(text.social_count(shown_count)).alias("total"))


@query(ctes(V_POSTS) + """select id, cast(seq as varchar) as post, username as autor,
  null::varchar as ninguno from posts""")
def status_urls(t: Tables) -> DataFrame:
    url = F.concat(F.lit("https://example.org/"), F.col("username"), F.lit("/status/"), F.col("seq").cast("string"),
                   F.lit("?s=20"))
    return t.posts().select("id", text.status_id(url).alias("post"), text.status_user(url).alias("autor"),
                            text.status_id(F.concat(F.lit("https://example.org/"), F.col("username"))).alias("ninguno"))


@query(ctes(V_POSTS) + """select source, nullif(source, 'other') as detected, count(*) as n from posts group by 1, 2""")
def source_from_file_name(t: Tables) -> DataFrame:
    name = F.concat(F.lit("Export_"), F.initcap("source"), F.lit("_"), F.col("seq").cast("string"), F.lit(".csv"))
    return t.posts().select("source", text.source_from_file_name(name).alias("detected")).groupBy(
        "source", "detected").agg(F.count(F.lit(1)).alias("n"))


@query(ctes(V_POSTS) + """select id, case when source = 'youtube' then id else 'yt_' || id end as con_prefijo,
  case when source = 'youtube' then source_id else id end as sin_prefijo from posts""")
def id_prefixes(t: Tables) -> DataFrame:
    return t.posts().select("id", text.ensure_prefix(F.col("id"), "yt_").alias("con_prefijo"),
                            text.drop_first(F.col("id"), "yt_").alias("sin_prefijo"))


# --- casts ------------------------------------------------------------------------------------------------------------

@query("""select l_linestatus, l_linenumber, count(*) as n,
  cast(sum(case when l_linenumber = 1 then null when l_linenumber = 2 then null else trunc(l_extendedprice) end) as bigint)
    as enteros,
  count(*) filter (where l_linenumber = 1) as vacios, count(*) filter (where l_linenumber <= 2) as nulos
  from lineitem group by 1, 2""")
def lenient_casts(t: Tables) -> DataFrame:
    raw = (F.when(F.col("l_linenumber") == 1, "nan").when(F.col("l_linenumber") == 2, "sin dato")
           .otherwise(F.col("l_extendedprice").cast("string")))
    blank = F.when(F.col("l_linenumber") == 1, "  ").when(F.col("l_linenumber") == 2, "None").otherwise("x")
    rows = t.lineitem.select("l_linestatus", "l_linenumber", casting.lenient_int(raw).alias("i"),
                             casting.text_or(raw).alias("s"), casting.blank_to_null(blank).alias("b"))
    return rows.groupBy("l_linestatus", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("i").alias("enteros"), F.count_if(F.col("s") == "").alias("vacios"),
        F.count_if(F.col("b").isNull()).alias("nulos"))


@query("""select o_orderkey, nullif(case when o_orderstatus = 'P' then '' else o_orderstatus end, '') as estado,
  case when o_orderstatus = 'P' then null else cast(trunc(o_totalprice) as bigint) end as precio from orders""")
def coerce_rows(t: Tables) -> DataFrame:
    blank = F.col("o_orderstatus") == "P"
    raw = t.orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                          F.when(blank, "").otherwise(F.col("o_orderstatus")).alias("estado"),
                          F.when(blank, "").otherwise(F.col("o_totalprice").cast("string")).alias("precio"))
    return casting.coerce_columns(raw, ["o_orderkey", "precio"])


@query("""select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as iso, strftime(ts, '%Y-%m-%d %H:%M:%S') as zulu,
  strftime(ts, '%Y-%m-%d %H:%M:%S') as espacio, strftime(ts + interval 5 hour, '%Y-%m-%d %H:%M:%S') as desfase,
  strftime(ts, '%Y-%m-%d 00:00:00') as dia, null::varchar as malo, strftime(ts, '%Y-%m-%d %H:%M:%S') as plano
  from events""")
def timestamp_forms(t: Tables) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    parsed = lambda c, name: shown(casting.lenient_timestamp(c)).alias(name)
    return t.events.select(
        "event_id", parsed(iso, "iso"), parsed(F.concat(iso, F.lit("Z")), "zulu"),
        parsed(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), "espacio"), parsed(F.concat(iso, F.lit("-05:00")), "desfase"),
        parsed(F.date_format(at, "yyyy-MM-dd"), "dia"), parsed(F.concat(F.lit("el "), iso), "malo"),
        casting.plain_timestamp_text(F.concat(iso, F.lit("Z"))).alias("plano"))


@query("""select vec_id, case when label % 3 = 0 then null else cast(label as double) end as valor,
  case when label % 3 = 1 then null else cast(label as double) end as en_mapa from embeddings""")
def finite_values(t: Tables) -> DataFrame:
    label = F.col("label").cast("double")
    some = F.when(F.col("label") % 3 == 0, F.lit(float("nan"))).otherwise(label)
    other = F.when(F.col("label") % 3 == 1, F.lit(float("-inf"))).otherwise(label)
    return t.embeddings.select("vec_id", casting.finite_or_null(some).alias("valor"),
                               casting.finite_map(F.create_map(F.lit("k"), other))["k"].alias("en_mapa"))


# --- calendar ---------------------------------------------------------------------------------------------------------

@query("""select event_id, strftime(ts - interval 5 hour, '%Y-%m-%d %H:%M:%S') as fecha,
  cast(ts - interval 5 hour as date) as dia from events""")
def local_time(t: Tables) -> DataFrame:
    local = timefn.local_time(F.col("ts").cast("timestamp"))
    return t.events.select("event_id", shown(local).alias("fecha"), F.to_date(local).alias("dia"))


@query("""select event_id, hour(ts) as hora, isodow(ts) - 1 as dia_semana,
  cast(floor((epoch_us(timestamp '2024-01-20 12:00:00') - epoch_us(ts)) / 86400000000.0) as int) as faltan
  from events""")
def calendar_features(t: Tables) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return t.events.select("event_id", timefn.hour_of_day(at).alias("hora"), timefn.day_of_week(at).alias("dia_semana"),
                           timefn.days_until(at, "2024-01-20 12:00:00").alias("faltan"))


@query("""select o_orderkey, (cast(o_orderdate as date) - (select min(cast(o_orderdate as date)) from orders)) // 3
    as ventana,
  (select min(cast(o_orderdate as date)) from orders) + cast(3 * ((cast(o_orderdate as date)
    - (select min(cast(o_orderdate as date)) from orders)) // 3) as int) as ini,
  (select min(cast(o_orderdate as date)) from orders) + cast(3 * ((cast(o_orderdate as date)
    - (select min(cast(o_orderdate as date)) from orders)) // 3) + 2 as int) as fin from orders""")
def fixed_windows(t: Tables) -> DataFrame:
    from agoralake.operators import windows
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    rows = windows.with_windows(orders, "at", windows.first_day(orders, "at"))
    return rows.select("o_orderkey", F.col("ventana").cast("bigint").alias("ventana"),
                       F.col("fecha_ini_ventana").alias("ini"), F.col("fecha_fin_ventana").alias("fin"))


@query("""select l_linenumber, count(*) as n, cast(sum(case l_linenumber when 1 then l_suppkey % 24 * 3600 + 5
  when 2 then l_suppkey % 60 * 60 when 3 then l_suppkey when 4 then 0 else l_suppkey % 24 * 3600 + l_suppkey % 60 * 60
  + l_suppkey end) as bigint) as segundos from lineitem group by 1""")
def iso_durations(t: Tables) -> DataFrame:
    n = F.col("l_suppkey")
    h, m, s = (n % 24).cast("string"), (n % 60).cast("string"), n.cast("string")
    line = F.col("l_linenumber")
    spelled = (F.when(line == 1, F.concat(F.lit("PT"), h, F.lit("H5S"))).when(line == 2, F.concat(F.lit("PT"), m, F.lit("M")))
               .when(line == 3, F.concat(F.lit("PT"), s, F.lit("S"))).when(line == 4, F.concat(F.lit("P1D"), s))
               .otherwise(F.concat(F.lit("PT"), h, F.lit("H"), m, F.lit("M"), s, F.lit("S"))))
    return t.lineitem.select("l_linenumber", timefn.iso_duration_seconds(spelled).alias("x")).groupBy(
        "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("segundos"))


@query("""select event_id, case when event_id = 0 then '' else strftime(to_timestamp(1700000000 + event_id * 61)::timestamp,
  '%Y-%m-%d %H:%M:%S') end as creado from events""")
def epoch_text(t: Tables) -> DataFrame:
    seconds = F.when(F.col("event_id") == 0, F.lit(0)).otherwise(F.col("event_id") * 61 + 1_700_000_000)
    return t.events.select("event_id", timefn.epoch_text(seconds).alias("creado"))


@query(ctes(V_RUNS) + "select run_id, cast(epoch(finished_at) - epoch(started_at) as int) as segundos from runs")
def run_durations(t: Tables) -> DataFrame:
    return t.runs().select("run_id", timefn.run_seconds(F.col("started_at"), F.col("finished_at")).alias("segundos"))


# --- scores -----------------------------------------------------------------------------------------------------------

@query(ctes(V_POSTS) + """select id, round(ln(1 + likes + retweets * 2 + shares * 2 + replies * 3 + views * 0.01::double), 6)
  as score, null::double as vacio from posts""")
def engagement_scores(t: Tables) -> DataFrame:
    none = F.map_filter("engagement", lambda k, _: k == "clics")
    return scale(t.posts().select("id", scoring.engagement_score(F.col("engagement"), None).alias("score"),
                                  scoring.engagement_score(none).alias("vacio")))


@query(ctes(V_POSTS) + """select id, round(case source when 'tiktok' then likes + shares * 2.0::double
  when 'twitter' then likes + retweets * 2 + replies * 1.5::double else likes end, 6) as engagement from posts""")
def network_engagement(t: Tables) -> DataFrame:
    return scale(t.posts().select("id", scoring.network_engagement(F.col("source"), F.col("engagement")).alias("engagement")))


def lexicon_sql(x: str = "t") -> str:
    def n(words: list[str]) -> str:
        return f"len(list_filter(string_split({x}, ' '), lambda w: w in ({', '.join(repr(w) for w in words)})))"
    return f"""scored as (select *, case when up > down then 'POS' when down > up then 'NEG' else 'NEU' end as label,
    case when up + down = 0 then 0.5::double else greatest(up, down) / (up + down) end as p,
    round(case when up > down then 1 when down > up then -1 else 0 end
      * case when up + down = 0 then 0.5::double else greatest(up, down) / (up + down) end, 4) as score
  from (select *, {n(POSITIVE)} as up, {n(NEGATIVE)} as down from norm))"""


@query(ctes(V_POSTS, V_NORM, lexicon_sql()) + """select id, label, round(p, 6) as p, score,
  case when score > 0.1 then 'positivo' when score < -0.1 then 'negativo' else 'neutro' end as sentimiento from scored""")
def lexicon_sentiment(t: Tables) -> DataFrame:
    scorer = scorers.LexiconScorer(POSITIVE, NEGATIVE)
    rows = normalised_posts(t).withColumn("r", scorer.result(F.col("t")))
    rows = rows.withColumn("score", scoring.signed_score(F.col("r.label"), F.col("r.score")))
    return scale(rows.select("id", F.col("r.label").alias("label"), F.col("r.score").alias("p"), "score",
                             scoring.sentiment_class(F.col("score")).alias("sentimiento")))


class LengthModel(scorers.BatchModel):
    """A model of the plainest kind: the parity of a text's length decides, its size gives the probability."""

    name, version = "length", "1.0"

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        return [("POS" if len(x) % 2 == 0 else "NEG", min(len(x), 5000) / 5000) for x in texts]


@query(ctes(V_POSTS, V_NORM) + """select id, round(case when length(t) % 2 = 0 then 1 else -1 end
  * (least(length(t), 5000) / 5000), 4) as score from norm""")
def model_scorer_batches(t: Tables) -> DataFrame:
    scorer = scorers.ModelScorer(LengthModel(), max_chars=None)
    rows = normalised_posts(t).select("id", scorer.result(F.col("t")).alias("r"))
    return rows.select("id", scoring.signed_score(F.col("r.label"), F.col("r.score")).alias("score"))


@query(ctes(V_POSTS) + "select id, 'neutral' as label, 0.5::double as score from posts")
def neutral_scorer(t: Tables) -> DataFrame:
    return t.posts().select("id", scorers.NeutralScorer().result(F.col("text")).alias("r")).select("id", "r.*")


@query(ctes(V_OPINIONS) + """select id, round(greatest(-1, least(1, score + intencion_explicita * 0.3::double)), 6)
  as compuesto, round(1 + ln(1 + greatest(engagement, 0)), 6) as peso from opinions""")
def composite_scores(t: Tables) -> DataFrame:
    return scale(t.opinions().select(
        "id", scoring.composite_score(F.col("score"), F.col("intencion_explicita")).alias("compuesto"),
        scoring.log_weight(F.col("engagement")).alias("peso")))


@query(ctes(V_RUNS) + """select run_id, round(abs(rows_out - (select avg(rows_out) from runs))
  / (select avg(rows_out) from runs) * 100, 6) as desvio from runs""")
def volume_deviation(t: Tables) -> DataFrame:
    runs = t.runs()
    mean = runs.agg(F.avg("rows_out")).scalar()
    return scale(runs.withColumn("m", mean).select(
        "run_id", scoring.percent_deviation(F.col("rows_out"), F.col("m")).alias("desvio")))


@query(ctes(V_POSTS) + """select id, array_to_string(list_sort(list_filter([
    case when likes > 2 then 'likes' end, case when views > 2 then 'views' end,
    case when shares > 2 then 'shares' end], lambda x: x is not null)), ', ') as altos,
  likes as likes_o_cero, 0 as plays_o_cero, true as tiene_identidad from posts""")
def map_functions(t: Tables) -> DataFrame:
    high = F.map_filter("engagement", lambda k, v: (v > 2) & k.isin("likes", "views", "shares"))
    kept = pii.without_keys(F.col("metadata"))
    return t.posts().select(
        "id", F.array_join(F.array_sort(F.map_keys(high)), ", ").alias("altos"),
        scoring.metric(F.col("engagement"), "likes").cast("bigint").alias("likes_o_cero"),
        scoring.metric(F.col("engagement"), "plays").cast("int").alias("plays_o_cero"),
        (pii.has_any_key(F.col("metadata")) & ~pii.has_any_key(kept)).alias("tiene_identidad"))


@query(f"""select source, count(*) as n, count(*) filter (where trim(coalesce(case when lang = 'de' then '  ' when lang = 'fr'
  then null else lang end, '')) = '') as vacios from documents group by 1""")
def emptiness(t: Tables) -> DataFrame:
    lang = F.when(F.col("lang") == "de", "  ").when(F.col("lang") == "fr", F.lit(None)).otherwise(F.col("lang"))
    rows = t.documents.select("source", lang.alias("campo"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(quality.is_empty("campo")).alias("vacios"))
