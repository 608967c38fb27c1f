"""Queries over windowed scores, as-of joins, the feature table, targets, sequences and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from agoralake.functions import timefn
from agoralake.operators import asof, feature_table as ft, forecast as fc, windows as wn
from agoralake.plans import layers, scorers
from agoralake.queries.layers import V_STANDARD, silver_posts
from agoralake.queries.registry import (
    PRIORITY_NETWORK, V_MENTIONS, V_OPINIONS, V_POLLS, Tables, ctes, query, scale, shown,
)
from agoralake.queries.text import DICTIONARIES, NEGATIVE, PHRASES, POSITIVE, REPORTING, lexicon_sql
from agoralake.session import stored
from agoralake.sources import files

# The names that occur in the tables, and one candidate that occurs in no poll.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
CANDIDATES = [*SEGMENTS, "AGRICULTURE"]
PREFIX = {"facebook": "SF", "youtube": "SY", "tiktok": "SX", "twitter": "ST", "other": "OTHER"}
N = len(CANDIDATES)
ORIGIN = "(select min(cast(fecha as date)) from opinions)"


def scores_sql(name: str, column: str, source: str = "opinions", origin: str = ORIGIN) -> str:
    return f"""{name} as (
  select entidad, red, ventana, {origin} + ventana * 3 as fecha_ini_ventana,
    {origin} + (ventana * 3 + 2) as fecha_fin_ventana, sum(comp * peso) / sum(peso) as score_final,
    avg(comp) as score_promedio, count(*) as menciones, sum(engagement) as engagement_total
  from (select {column} as entidad, red, cast((cast(fecha as date) - {origin}) // 3 as int) as ventana, engagement,
      greatest(-1, least(1, score + intencion_explicita * 0.3::double)) as comp,
      1 + ln(1 + greatest(engagement, 0)) as peso from {source}) group by 1, 2, 3)"""


V_CAND_SCORES, V_PARTY_SCORES = scores_sql("cs", "candidato"), scores_sql("ps", "partido")
_SCORES = """entidad, red, ventana, fecha_ini_ventana, fecha_fin_ventana, round(score_final, 6) as score_final,
  round(score_promedio, 6) as score_promedio, menciones, round(engagement_total, 6) as engagement_total"""


def candidate_scores(t: Tables) -> DataFrame:
    return wn.windowed_scores(t.opinions(), "candidatos")


def party_scores(t: Tables) -> DataFrame:
    return wn.windowed_scores(t.opinions(), "partidos")


# --- windowed scores --------------------------------------------------------------------------------------------------

@query(ctes(V_OPINIONS, V_CAND_SCORES) + f"select {_SCORES} from cs")
def windowed_scores_by_candidate(t: Tables) -> DataFrame:
    return scale(candidate_scores(t))


@query(ctes(V_OPINIONS, V_PARTY_SCORES) + f"select {_SCORES} from ps")
def windowed_scores_by_party(t: Tables) -> DataFrame:
    return scale(party_scores(t))


V_SCORED_POSTS = ",\n".join([
    V_STANDARD, lexicon_sql("texto_usuario_norm"),
    f"""statements as (select s.source as red, c.entity, s.datetime_utc - interval 5 hour as fecha, s.score,
    case when regexp_matches(texto_usuario_norm, '(^| )({'|'.join(REPORTING)})( |$)') then 0
      when regexp_matches(texto_usuario_norm, '(^| )({'|'.join(PHRASES)})( |$)') then 1 else 0 end as intencion_explicita,
    case source when 'tiktok' then likes + shares * 2.0::double
      when 'twitter' then likes + retweets * 2 + replies * 1.5::double else likes end as engagement
    from scored s join cands c using (seq))""",
    scores_sql("ws", "entity", "statements", "(select min(cast(fecha as date)) from statements)"),
])


@query(ctes(V_SCORED_POSTS) + f"select {_SCORES.replace(', 6)', ', 10)')} from ws")
def post_scores_end_to_end(t: Tables) -> DataFrame:
    """Raw posts -> silver -> analysis rows -> sentiment -> windowed scores."""
    rows = layers.standardise(silver_posts(t), **DICTIONARIES).withColumn(
        "intencion_explicita", layers.stated_intention(F.col("texto_usuario"), PHRASES, REPORTING))
    scored = stored(scorers.with_sentiment(rows, scorers.LexiconScorer(POSITIVE, NEGATIVE)), "scored")
    return scale(wn.windowed_scores(scored, "candidatos"), 10)


_PERIOD = ("1996-03-08 00:00:00", "1996-06-12 00:00:00")
V_PERIOD = f"inside as (select * from opinions where fecha between timestamp '{_PERIOD[0]}' and timestamp '{_PERIOD[1]}')"


@query(ctes(V_OPINIONS, V_PERIOD, scores_sql("ps", "partido", "inside", "(select min(cast(fecha as date)) from inside)"))
       + f"select {_SCORES} from ps")
def period_scores(t: Tables) -> DataFrame:
    return scale(wn.period_scores(t.opinions(), "partidos", *_PERIOD))


@query(ctes(V_OPINIONS, V_CAND_SCORES) + "select distinct ventana, fecha_ini_ventana, fecha_fin_ventana from cs")
def window_list(t: Tables) -> DataFrame:
    return wn.window_list(candidate_scores(t))


@query(ctes(V_STANDARD) + "select entity as entidad, count(*) as menciones from cands join norm using (seq) group by 1")
def entity_counts(t: Tables) -> DataFrame:
    return wn.entity_counts(layers.standardise(silver_posts(t), **DICTIONARIES), "candidatos")


@query(ctes(V_STANDARD) + """select party as entidad, count(*) as menciones from parties join norm using (seq) group by 1
  order by 2 desc, 1 limit 2""")
def top_parties(t: Tables) -> DataFrame:
    return wn.top_entities(layers.standardise(silver_posts(t), **DICTIONARIES), "partidos", 2)


@query(ctes(V_OPINIONS) + "select red, candidato, count(*) as registros from opinions group by 1, 2")
def counts_by_network(t: Tables) -> DataFrame:
    return wn.counts_by(t.opinions(), "red", "candidato")


@query(ctes(V_OPINIONS) + """select red, strftime(min(fecha), '%Y-%m-%d %H:%M:%S') as min_fecha,
  strftime(max(fecha), '%Y-%m-%d %H:%M:%S') as max_fecha, count(*) as registros from opinions group by 1""")
def date_spans(t: Tables) -> DataFrame:
    return wn.date_spans(t.opinions(), ["red"]).withColumns({c: shown(c) for c in ("min_fecha", "max_fecha")})


@query(ctes(V_OPINIONS, V_CAND_SCORES) + """select entidad, round(avg(score_final), 6) as score_promedio,
  cast(sum(menciones) as bigint) as menciones_total, cast(row_number() over (order by avg(score_final) desc, entidad) as int)
  as posicion from cs group by 1""")
def ranking(t: Tables) -> DataFrame:
    return scale(wn.ranking(candidate_scores(t)))


@query(ctes(V_OPINIONS, V_CAND_SCORES) + f"select {_SCORES} from cs order by entidad, red, ventana limit 10")
def first_scores_in_order(t: Tables) -> DataFrame:
    return scale(candidate_scores(t).orderBy("entidad", "red", "ventana").limit(10))


@query(ctes(V_OPINIONS, V_CAND_SCORES) + "select entidad, count(*) as ventanas from cs group by 1")
def windows_per_entity(t: Tables) -> DataFrame:
    return candidate_scores(t).groupBy("entidad").agg(F.count(F.lit(1)).alias("ventanas"))


# --- polls, as-of, filling --------------------------------------------------------------------------------------------

V_POLL_MEANS = """pm as (select fecha, candidato, avg(intencion_voto) as intencion_voto from polls group by 1, 2)"""
V_WINDOWS = "wins as (select distinct ventana, fecha_ini_ventana as ini, fecha_fin_ventana as fin from cs)"
V_IN_FORCE = """force as (select ventana, ini, coalesce((select max(fecha) from polls where fecha <= ini),
    (select min(fecha) from polls)) as fecha from wins)"""


@query(ctes(V_POLLS, V_POLL_MEANS) + "select fecha, candidato, round(intencion_voto, 6) as intencion_voto from pm")
def poll_means(t: Tables) -> DataFrame:
    return scale(ft.poll_means(t.polls()))


@query(ctes(V_POLLS) + """select fecha, encuestadora, candidato, case when encuestadora = '5-LOW' then 0
  else intencion_voto end as intencion_voto from polls""")
def poll_file_rows(t: Tables) -> DataFrame:
    value = F.when(F.col("encuestadora") == "5-LOW", "s/d").otherwise(F.col("intencion_voto").cast("string"))
    return files.polls(t.polls().withColumn("intencion_voto", value).withColumn("fecha", F.col("fecha").cast("string")))


@query(ctes(V_OPINIONS, V_CAND_SCORES, V_POLLS, V_WINDOWS, V_IN_FORCE) + "select ventana, ini as fecha_ini_ventana, fecha from force")
def poll_date_of_window(t: Tables) -> DataFrame:
    return ft.poll_date_of_window(candidate_scores(t), t.polls())


@query(ctes(V_OPINIONS, V_POLLS, V_POLL_MEANS) + """select o.id, round(pm.intencion_voto, 6) as intencion_voto,
  pm.fecha as asof_fecha from opinions o asof left join pm on pm.candidato = o.candidato and cast(o.fecha as date) >= pm.fecha""")
def asof_join_by_candidate(t: Tables) -> DataFrame:
    """Every statement with the poll of its candidate that was known then."""
    left = t.opinions().select("id", "candidato", F.to_date("fecha").alias("dia"))
    right = ft.poll_means(t.polls())
    out = asof.asof_join(left, right, ["candidato"], "dia", "fecha", ["intencion_voto"], block_days=90)
    return scale(out.select("id", "intencion_voto", "asof_fecha"))


@query(ctes(V_OPINIONS, V_POLLS, V_POLL_MEANS) + """select o.id, round(coalesce(pm.intencion_voto, f.v), 6) as intencion_voto
  from opinions o asof left join pm on pm.candidato = o.candidato and cast(o.fecha as date) >= pm.fecha
  join (select candidato, arg_min(intencion_voto, fecha) as v from pm group by 1) f on f.candidato = o.candidato""")
def asof_join_with_fallback(t: Tables) -> DataFrame:
    left = t.opinions().select("id", "candidato", F.to_date("fecha").alias("dia"))
    out = asof.asof_join(left, ft.poll_means(t.polls()), ["candidato"], "dia", "fecha", ["intencion_voto"],
                         fallback_first=True)
    return scale(out.select("id", "intencion_voto"))


def _poll_columns(names: list[str] = SEGMENTS) -> str:
    return ", ".join(f"avg(case when candidato = '{c}' then intencion_voto end) as \"ENC_{c}\"" for c in names)


@query(ctes(V_POLLS, V_POLL_MEANS, f"w as (select fecha, {_poll_columns()} from pm group by 1)") + "select fecha, "
       + ", ".join(f'round("ENC_{c}", 6) as "ENC_{c}"' for c in SEGMENTS) + " from w")
def pivot_polls(t: Tables) -> DataFrame:
    return scale(ft.pivot_polls(t.polls())[0])


@query(ctes(V_MENTIONS) + """select fecha, medio, candidato, coalesce(last_value(case when menciones > 2 then menciones end
  ignore nulls) over (partition by medio, candidato order by fecha rows unbounded preceding), 0) as menciones
  from (select fecha, medio, candidato, sum(menciones)::bigint as menciones from mentions group by 1, 2, 3)""")
def forward_fill(t: Tables) -> DataFrame:
    rows = t.mentions().groupBy("fecha", "medio", "candidato").agg(F.sum("menciones").alias("menciones"))
    rows = rows.withColumn("menciones", F.when(F.col("menciones") > 2, F.col("menciones")))
    return asof.forward_fill(rows, ["menciones"], ["fecha"], ["medio", "candidato"], F.lit(0))


# --- targets ----------------------------------------------------------------------------------------------------------

_NAMES = ", ".join(f"('{c}')" for c in CANDIDATES)
V_TARGETS = f"""names as (select * from (values {_NAMES}) as n(candidato)),
grid as (select distinct p.fecha, n.candidato from polls p, names n),
levels as (select fecha, candidato, coalesce(last_value(intencion_voto ignore nulls) over (partition by candidato
    order by fecha rows unbounded preceding), 1.0::double / {N}) as bruto from grid left join pm using (fecha, candidato)),
norm_levels as (select *, bruto / case when sum(bruto) over (partition by fecha) = 0 then 1
    else sum(bruto) over (partition by fecha) end as nivel from levels),
deltas as (select *, nivel - coalesce(lag(nivel) over (partition by candidato order by fecha), 1.0::double / {N}) as delta
    from norm_levels),
moves as (select *, exp(delta / 0.3::double) / sum(exp(delta / 0.3::double)) over (partition by fecha) as delta_soft
    from deltas),
mixed as (select ventana, ini, candidato, nivel, 0.75::double * nivel + 0.25::double * delta_soft as bruto
    from force join moves using (fecha)),
targets as (select ventana, ini, candidato, nivel, bruto / sum(bruto) over (partition by ventana) as objetivo from mixed)"""
V_ALL_TARGETS = ",\n".join([V_OPINIONS, V_CAND_SCORES, V_POLLS, V_POLL_MEANS, V_WINDOWS, V_IN_FORCE, V_TARGETS])


def target_rows(t: Tables) -> DataFrame:
    windows = stored(candidate_scores(t).select("ventana", "fecha_ini_ventana").distinct(), "windows")
    return fc.targets(stored(t.polls(), "polls"), CANDIDATES, windows, 0.75, 0.25)


@query(ctes(V_ALL_TARGETS) + "select fecha, candidato, round(bruto, 6) as nivel from levels")
def carried_levels(t: Tables) -> DataFrame:
    return scale(fc.carried_levels(t.polls(), CANDIDATES))


@query(ctes(V_ALL_TARGETS) + """select fecha, candidato, round(nivel, 6) as nivel, round(delta, 6) as delta,
  round(delta_soft, 6) as delta_soft from moves""")
def poll_movements(t: Tables) -> DataFrame:
    return scale(fc.movements(t.polls(), CANDIDATES))


@query(ctes(V_ALL_TARGETS) + """select ventana, ini as fecha_ini_ventana, candidato, round(nivel, 6) as nivel,
  round(objetivo, 6) as objetivo from targets""")
def window_targets(t: Tables) -> DataFrame:
    return scale(target_rows(t))


@query(ctes(V_ALL_TARGETS) + """select candidato, round(avg(objetivo), 6) as media, round(min(objetivo), 6) as minimo,
  round(max(objetivo), 6) as maximo from targets group by 1""")
def target_summary(t: Tables) -> DataFrame:
    return scale(fc.target_summary(target_rows(t)))


# --- feature table ----------------------------------------------------------------------------------------------------

def _score_columns(kind: int, names: list[str]) -> dict[str, str]:
    return {
        f"{PREFIX[red]}{kind}_{e.replace(' ', '_')}":
            f"avg(case when red = '{red}' and entidad = '{e}' then score_final end)"
        for red in PRIORITY_NETWORK.values() for e in names
    }


_C1, _C2 = _score_columns(1, SEGMENTS), _score_columns(2, REGIONS)


def _pivot_sql(name: str, source: str, columns: dict[str, str]) -> str:
    cols = ", ".join(f'{v} as "{k}"' for k, v in columns.items())
    return f"{name} as (select ventana, fecha_ini_ventana as ini, fecha_fin_ventana as fin, {cols} from {source} group by 1, 2, 3)"


def _means(kind: int, names: list[str], source: str) -> dict[str, str]:
    out = {}
    for e in names:
        slug = e.replace(" ", "_")
        parts = ", ".join(f'{source}."{p}{kind}_{slug}"' for p in PREFIX.values())
        out[f"SP{kind}_{slug}"] = f"list_avg(list_filter([{parts}], lambda x: x is not null))"
    return out


_MEANS = {**_means(1, SEGMENTS, "p1"), **_means(2, REGIONS, "p2")}
V_MOMENTUM = "mom as (select ventana, " + ", ".join(
    f"avg(case when candidato = '{c}' then menciones end) as \"M_{c}\"" for c in SEGMENTS) + f"""
  from (select *, cast((fecha - {ORIGIN}) // 3 as int) as ventana from mentions) group by 1)"""
_FILLED = {f"ENC_{c}": f"""last_value("ENC_{c}" ignore nulls) over (order by coalesce(p1.ventana, p2.ventana)
  rows unbounded preceding)""" for c in SEGMENTS}
_FEATURES = [*_C1, *_C2, *_MEANS, *_FILLED, *[f"M_{c}" for c in SEGMENTS]]
V_FEATURES = ",\n".join([
    V_OPINIONS, V_CAND_SCORES, V_PARTY_SCORES, V_POLLS, V_POLL_MEANS, V_MENTIONS, V_WINDOWS, V_IN_FORCE,
    f"wide_polls as (select fecha, {_poll_columns()} from pm group by 1)",
    _pivot_sql("p1", "cs", _C1), _pivot_sql("p2", "ps", _C2), V_MOMENTUM,
    "features as (select coalesce(p1.ventana, p2.ventana) as ventana, coalesce(p1.ini, p2.ini) as fecha_ini_ventana, "
    "coalesce(p1.fin, p2.fin) as fecha_fin_ventana, "
    + ", ".join([f'coalesce("{c}", 0) as "{c}"' for c in [*_C1, *_C2]]
                + [f'coalesce({v}, 0) as "{k}"' for k, v in {**_MEANS, **_FILLED}.items()]
                + [f'coalesce("M_{c}", 0) as "M_{c}"' for c in SEGMENTS])
    + """ from p1 full join p2 on p1.ventana = p2.ventana and p1.ini = p2.ini and p1.fin = p2.fin
      left join force on force.ventana = coalesce(p1.ventana, p2.ventana) left join wide_polls using (fecha)
      left join mom on mom.ventana = coalesce(p1.ventana, p2.ventana))""",
])


def window_momentum(t: Tables) -> DataFrame:
    start = wn.first_day(t.opinions(), "fecha")
    rows = t.mentions().withColumn("_o", start)
    rows = rows.withColumn("ventana", timefn.window_index(F.col("fecha"), F.col("_o")))
    wide = rows.withColumn("c", F.concat(F.lit("M_"), "candidato")).groupBy("ventana").pivot(
        "c", [f"M_{c}" for c in SEGMENTS]).agg(F.avg("menciones"))
    return files.window_momentum(wide.select([F.col(c).cast("string") for c in wide.columns]))


def features(t: Tables) -> DataFrame:
    """As in the analysis job, the scores are stored before the wide table is built, and so is that table."""
    cand, party = stored(candidate_scores(t), "scores"), stored(party_scores(t), "scores")
    return stored(ft.build_feature_table(cand, party, stored(t.polls(), "polls"), window_momentum(t)), "features")


def _rounded(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f'round("{c}", {digits}) as "{c}"' for c in columns)


@query(ctes(V_FEATURES) + f"select ventana, fecha_ini_ventana, fecha_fin_ventana, {_rounded(_FEATURES)} from features")
def feature_table(t: Tables) -> DataFrame:
    return scale(features(t))


@query(ctes(V_OPINIONS, V_CAND_SCORES, _pivot_sql("p1", "(select * from cs where entidad in ('BUILDING', 'MACHINERY'))", _C1))
       + "select ventana, " + _rounded([c for c in _C1 if c.endswith(("BUILDING", "MACHINERY"))]) + " from p1")
def pivot_scores_of_chosen(t: Tables) -> DataFrame:
    wide, _ = ft.pivot_scores(candidate_scores(t), 1, ft.first_name_slug(F.col("entidad")), ["BUILDING", "MACHINERY"])
    return scale(wide.drop("fecha_ini_ventana", "fecha_fin_ventana"))


@query(ctes(V_OPINIONS, V_CAND_SCORES, _pivot_sql("p1", "cs", _C1)) + "select ventana, "
       + ", ".join(f'round({v}, 6) as "{k}"' for k, v in _means(1, SEGMENTS, "p1").items()) + " from p1")
def means_over_networks(t: Tables) -> DataFrame:
    wide, names = ft.pivot_scores(candidate_scores(t), 1, ft.first_name_slug(F.col("entidad")))
    rows, means = ft.with_network_means(wide, names, 1)
    return scale(rows.select("ventana", *means))


@query(ctes(V_OPINIONS, V_MENTIONS, V_MOMENTUM) + "select ventana, " + _rounded([f"M_{c}" for c in SEGMENTS]) + " from mom")
def window_momentum_file(t: Tables) -> DataFrame:
    return scale(window_momentum(t))


# --- scaling, sequences, split, forecast, metrics ---------------------------------------------------------------------

_USED = ["SP1_BUILDING", "SP2_ASIA", "ENC_BUILDING", "M_FURNITURE"]


def _scaled(c: str) -> str:
    return f'coalesce(("{c}" - min("{c}") over ()) / nullif(max("{c}") over () - min("{c}") over (), 0), 0)'


V_SCALED = "scaled as (select ventana, fecha_fin_ventana, " + ", ".join(f'{_scaled(c)} as "{c}"' for c in _USED) + \
    ", 0.0::double as constante from features)"


def scaled_features(t: Tables) -> DataFrame:
    rows = features(t).withColumn("constante", F.lit(7.0))
    return fc.min_max_scaled(rows, [*_USED, "constante"])


@query(ctes(V_FEATURES, V_SCALED) + f"select ventana, {_rounded([*_USED, 'constante'])} from scaled")
def min_max_scaled(t: Tables) -> DataFrame:
    return scale(scaled_features(t).select("ventana", *_USED, "constante"))


def _flat(c: Column) -> Column:
    """A history as text: vectors joined by ``;``, whole thousandths joined by ``,``."""
    number = lambda v: F.round(v * 1000).cast("bigint").cast("string")
    return F.array_join(F.transform(c, lambda step: F.array_join(F.transform(step, number), ",")), ";")


_STEP = " || ',' || ".join(f'cast(cast(round("{c}" * 1000) as bigint) as varchar)' for c in _USED)


@query(ctes(V_FEATURES, V_SCALED) + f"""select ventana, historia from (select ventana, string_agg({_STEP}, ';') over w as historia,
  count(*) over w as n from scaled window w as (order by ventana rows between 4 preceding and 1 preceding)) where n = 4""")
def history_sequences(t: Tables) -> DataFrame:
    return fc.sequences(scaled_features(t), _USED).select("ventana", _flat(F.col("historia")).alias("historia"))


@query(ctes(V_FEATURES, V_SCALED) + f"""select string_agg({_STEP}, ';' order by ventana) as historia,
  max(fecha_fin_ventana) + 1 as fecha_ini, max(fecha_fin_ventana) + 3 as fecha_fin
  from (select * from scaled order by ventana desc limit 4)""")
def last_sequence(t: Tables) -> DataFrame:
    rows = fc.last_sequence(scaled_features(t), _USED)
    return rows.select(_flat(F.col("historia")).alias("historia"), "fecha_ini", "fecha_fin")


@query(ctes(V_OPINIONS, V_CAND_SCORES, V_WINDOWS) + """select ventana, case when k < floor(n * 0.7) then 'train'
  when k < floor(n * 0.7) + floor(n * 0.15) then 'validation' else 'test' end as parte
  from (select ventana, row_number() over (order by ventana) - 1 as k, count(*) over () as n from wins)""")
def time_split(t: Tables) -> DataFrame:
    return fc.time_split(candidate_scores(t).select("ventana").distinct())


_POLL_COLS = [f"ENC_{c}" for c in SEGMENTS]
V_PRED = ("prev as (select ventana, " + ", ".join(
    f'lag("{c}") over w as "{c}", row_number() over w as k' if i == 0 else f'lag("{c}") over w as "{c}"'
    for i, c in enumerate(_POLL_COLS)) + " from features window w as (order by ventana)),\n" + "preds as (" + " union all ".join(
    f"""select ventana, '{c}' as candidato, "ENC_{c}" / ({' + '.join(f'"{x}"' for x in _POLL_COLS)}) as pred from prev where k > 4"""
    for c in SEGMENTS) + ")")
V_JOINED = """joined as (select ventana, candidato, pred, objetivo as real from preds join targets using (ventana, candidato)),
changes as (select ventana, candidato, coalesce(nivel - lag(nivel) over (partition by candidato order by ventana), 0) as cambio
  from targets)"""
V_METRICS = ",\n".join([V_FEATURES, V_TARGETS, V_PRED, V_JOINED])


def predictions(t: Tables) -> DataFrame:
    """Persistence forecast from the poll columns of the last window."""
    model = fc.PersistenceForecaster(range(len(SEGMENTS)))
    return fc.forecast(fc.sequences(features(t), _POLL_COLS), model, SEGMENTS)


def evaluated(t: Tables) -> DataFrame:
    truth = target_rows(t).select("ventana", "candidato", F.col("objetivo").alias("real"))
    return predictions(t).join(truth, ["ventana", "candidato"])


@query(ctes(V_METRICS) + "select ventana, candidato, round(pred, 6) as pred from preds")
def persistence_forecast(t: Tables) -> DataFrame:
    return scale(predictions(t))


@query(ctes(V_METRICS) + """select round(1 - sum((real - pred) ** 2) / (sum(real * real) - sum(real) ** 2 / count(*)), 5) as r2,
  round(avg(abs(pred - real)), 6) as mae, round(avg(case when real > 0.01 then abs((real - pred) / real) end) * 100, 5) as mape,
  round(sum((real - pred) ** 2) / count(distinct ventana), 6) as brier,
  round(sum(real * (ln(real + 1e-8) - ln(pred + 1e-8))) / count(distinct ventana), 6) as kl from joined""")
def overall_metrics(t: Tables) -> DataFrame:
    return scale(scale(fc.overall_metrics(evaluated(t)), 5, "r2", "mape"))


@query(ctes(V_METRICS) + """select candidato, round(avg(abs(pred - real)) * 100, 5) as mae_puntos,
  round(avg(case when real > 0.01 then abs((real - pred) / real) end) * 100, 5) as mape,
  round(case when var_pop(real) * count(*) > 1e-6 then 1 - sum((real - pred) ** 2) / (var_pop(real) * count(*)) end, 4) as r2
  from joined group by 1""")
def candidate_metrics(t: Tables) -> DataFrame:
    return scale(scale(fc.candidate_metrics(evaluated(t)), 5, "mae_puntos", "mape"), 4, "r2")


@query(ctes(V_METRICS) + """select candidato, round(avg(case when (pred > 1.0::double / 5) = (cambio > 0) then 1 else 0 end) * 100, 5)
  as acierto, avg(case when cambio > 0 then 1 else 0 end) > 0.5 as sube from joined join changes using (ventana, candidato)
  group by 1""")
def direction_accuracy(t: Tables) -> DataFrame:
    levels = fc.with_level_change(target_rows(t)).select("ventana", "candidato", "cambio")
    rows = evaluated(t).join(levels, ["ventana", "candidato"])
    return scale(fc.direction_accuracy(rows, len(SEGMENTS)), 5)


@query(ctes(V_METRICS) + """select candidato, round(avg(pred), 6) as pred_media, round(avg(real), 6) as real_media
  from joined group by 1""")
def mean_pred_and_real(t: Tables) -> DataFrame:
    return scale(fc.mean_pred_and_real(evaluated(t)))


@query(ctes(V_METRICS) + """select candidato, round(avg(pred), 6) as pred, case when avg(pred) > 1.0::double / 5 then 'SUBE'
  else 'BAJA' end as direccion from preds group by 1""")
def ranked_predictions(t: Tables) -> DataFrame:
    mean = predictions(t).groupBy("candidato").agg(F.avg("pred").alias("pred"))
    return scale(fc.ranked_predictions(mean, len(SEGMENTS)))
