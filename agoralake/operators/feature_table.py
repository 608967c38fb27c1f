"""Wide feature table per window: pivoted scores, means over networks, polls as of the window, media momentum."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agoralake.functions.text import first_name_slug, network_prefix, underscore_slug
from agoralake.operators.asof import asof_join, forward_fill

# Characters of an entity that its columns are named by, where that names one entity only.
PARTY_CHARS, POLL_CHARS = 20, 15

KEYS = ["ventana", "fecha_ini_ventana", "fecha_fin_ventana"]


def row_mean(columns: Sequence[str]) -> Column:
    """Mean of the columns that are present in a row; NULL when none is."""
    values = F.filter(F.array(*[F.col(f"`{c}`") for c in columns]), lambda v: v.isNotNull())
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return F.try_divide(total, F.size(values))


def unique_slugs(df: DataFrame, entity: str, short: Column) -> Column:
    """``short`` as a name for each entity; entities that would share one are named by all their words, and numbered in
    order if even those agree. Entities become columns, so their names are few and come to the driver."""
    rows = df.where(F.col(entity).isNotNull()).select(
        F.col(entity).alias("entity"), short.alias("short"), underscore_slug(F.col(entity)).alias("long")).distinct().collect()
    rows, names = sorted(set(map(tuple, rows))), {}
    for i in (1, 2):
        count = Counter(r[i] for r in rows if r[0] not in names)
        used = set(names.values())
        names.update({r[0]: r[i] for r in rows if r[0] not in names and count[r[i]] == 1 and r[i] not in used})
    for e, _, long in rows:
        if e not in names:
            k = 2
            while f"{long}_{k}" in names.values():
                k += 1
            names[e] = f"{long}_{k}"
    if not names:
        return short
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col(entity))


def _names(df: DataFrame, column: str) -> list[str]:
    """Column names for a pivot: one per network and entity, a handful of short strings."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def pivot_scores(scores: DataFrame, kind: int, slug: Column, entities: Sequence[str] | None = None,
                 names: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """One column per network and entity. Pass ``names`` to save the job that looks them up."""
    rows = scores.where(F.col("entidad").isin(list(entities))) if entities else scores
    slug = unique_slugs(rows, "entidad", slug)
    rows = rows.withColumn("_name", F.concat(network_prefix(F.col("red")), F.lit(f"{kind}_"), slug))
    names = list(names) if names is not None else _names(rows, "_name")
    wide = rows.groupBy(*KEYS).pivot("_name", names).agg(F.avg("score_final"))
    return wide, names


def with_network_means(wide: DataFrame, names: Sequence[str], kind: int) -> tuple[DataFrame, list[str]]:
    slugs = sorted({n.split("_", 1)[1] for n in names})
    means = {f"SP{kind}_{s}": row_mean([n for n in names if n.endswith(f"{kind}_{s}")]) for s in slugs}
    return wide.withColumns(means), list(means)


def poll_means(polls: DataFrame) -> DataFrame:
    return polls.groupBy("fecha", "candidato").agg(F.avg("intencion_voto").alias("intencion_voto"))


def pivot_polls(polls: DataFrame, names: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    rows = poll_means(polls)
    rows = rows.withColumn("_name", F.concat(F.lit("ENC_"), unique_slugs(
        rows, "candidato", first_name_slug(F.col("candidato"), POLL_CHARS))))
    names = list(names) if names is not None else _names(rows, "_name")
    return rows.groupBy("fecha").pivot("_name", names).agg(F.avg("intencion_voto")), names


def poll_date_of_window(windows: DataFrame, polls: DataFrame) -> DataFrame:
    """(ventana, fecha_ini_ventana, fecha): the poll date in force when a window starts, else the first one."""
    dates = polls.select("fecha").where(F.col("fecha").isNotNull()).distinct().withColumn("_f", F.col("fecha"))
    starts = windows.select("ventana", "fecha_ini_ventana").distinct()
    return asof_join(starts, dates, [], "fecha_ini_ventana", "_f", ["fecha"], block_days=365, fallback_first=True).select(
        "ventana", "fecha_ini_ventana", "fecha")


def polls_by_window(polls: DataFrame, windows: DataFrame,
                    names: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    wide, names = pivot_polls(polls, names)
    in_force = poll_date_of_window(windows, polls)
    return in_force.join(wide, "fecha", "left").select("ventana", "fecha_ini_ventana", *names), names


def build_feature_table(candidate_scores: DataFrame, party_scores: DataFrame, polls: DataFrame | None = None,
                        momentum: DataFrame | None = None, candidates: Sequence[str] | None = None,
                        parties: Sequence[str] | None = None) -> DataFrame:
    """All features of a window in one row; what is missing becomes 0.

    The means over networks are taken before missing scores become 0, so they cover the networks present.
    """
    cand, cand_names = pivot_scores(candidate_scores, 1, first_name_slug(F.col("entidad")), candidates)
    party, party_names = pivot_scores(party_scores, 2, underscore_slug(F.col("entidad"), PARTY_CHARS), parties)
    wide = cand.join(party, KEYS, "full")
    wide, mean1 = with_network_means(wide, cand_names, 1)
    wide, mean2 = with_network_means(wide, party_names, 2)
    columns = [*cand_names, *party_names, *mean1, *mean2]
    if polls is not None:
        windows = candidate_scores.select(*KEYS).unionByName(party_scores.select(*KEYS))
        by_window, names = polls_by_window(polls, windows)
        wide = wide.join(by_window.drop("fecha_ini_ventana"), "ventana", "left")
        wide = forward_fill(wide, names, ["ventana"], default=F.lit(0.0))
        columns += names
    if momentum is not None:
        extra = [c for c in momentum.columns if c != "ventana"]
        wide = wide.join(momentum, "ventana", "left")
        columns += extra
    return wide.fillna(0.0, subset=columns).select(*KEYS, *columns)
