"""The transforms between layers: raw posts -> silver posts -> gold features -> analysis rows."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from agoralake.functions import pii, scoring, text, timefn
from agoralake.functions.casting import lenient_timestamp
from agoralake.operators.dedupe import dedupe, unseen
from agoralake.operators.entities import stated_intention, with_entities
from agoralake.operators.quality import split_valid


# --- language ---------------------------------------------------------------------------------------------------------

def langdetect_detector() -> Callable[[str], str] | None:
    """A detector from the optional ``langdetect`` package, or None when it is not installed."""
    try:
        from langdetect import DetectorFactory, detect
    except ImportError:
        return None
    DetectorFactory.seed = 0
    return detect


def with_language_fallback(df: DataFrame, text_column: str, lang: str = "lang",
                           detector: Callable[[str], str] | None = None) -> DataFrame:
    """Ask a detector about rows whose language is unknown. Texts already settled are not sent to Python."""
    tiny = F.coalesce(F.length(text.trim_spaces(F.col(text_column))), F.lit(0)) < 3
    open_case = F.col(lang).isNull() | (F.col(lang) == "unknown")
    settled = F.when(tiny, F.lit(None).cast("string")).otherwise(F.col(lang))
    if detector is None:
        return df.withColumn(lang, F.when(open_case, settled).otherwise(F.col(lang)))

    @F.pandas_udf(T.StringType())
    def detect(values: pd.Series) -> pd.Series:
        def one(value):
            if value is None:
                return None
            try:
                return detector(value)
            except Exception:  # noqa: BLE001 - detectors raise on texts without letters
                return None
        return values.map(one)

    asked = detect(F.when(open_case & ~tiny, F.col(text_column)))
    return df.withColumn("_asked", asked).withColumn(
        lang, F.when(open_case & ~tiny, F.coalesce("_asked", lang)).when(open_case, settled).otherwise(F.col(lang))
    ).drop("_asked")


# --- silver -----------------------------------------------------------------------------------------------------------

def clean(posts: DataFrame) -> DataFrame:
    """Cleaned text, flags and language next to the original text."""
    return (
        text.once(posts, _n=text.normalized(F.col("text")))
        .withColumn("lang", text.detect_spanish(F.col("text")))
        .withColumnRenamed("text", "text_original")
        .select("*", "_n.*").drop("_n")
        .withColumn("is_duplicate", F.lit(False))
    )


def anonymise(cleaned: DataFrame) -> DataFrame:
    """Author id in place of the user name, identity keys removed, personal data in the original text masked."""
    named = cleaned.withColumn("author_id", F.nullif(F.col("username"), F.lit(""))).drop("username")
    named = named.withColumn("metadata", pii.without_keys(F.col("metadata")))
    return pii.with_masking(named, "text_original")


def to_silver(posts: DataFrame, seen_ids: DataFrame | None, run_id: str, cleaned_at: Column, mask_first: bool = False,
              detector: Callable[[str], str] | None = None, order_by: tuple[str, ...] = ("seq",),
              one_of: Callable[..., DataFrame] = dedupe, arrange: Callable[[DataFrame], DataFrame] = lambda df: df,
              ) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows) for posts that are new.

    The first row of an id stays; ids already in silver are skipped. Duplicates inside the batch go before the join, so
    a post repeated many times enters it once. With ``mask_first`` the cleaned text is made from the masked text, which
    keeps phone numbers out of it as well. ``one_of`` is ``dedupe`` or does the same. ``arrange`` deals the posts out before
    they are cleaned, while they hold their text once.
    """
    fresh = one_of(posts, ["id"], list(order_by), keep="first")
    if seen_ids is not None:
        fresh = unseen(fresh, seen_ids, ["id"])
    fresh = arrange(fresh)
    if mask_first:
        rows = anonymise(fresh.withColumnRenamed("text", "text_original"))
        rows = clean(rows.withColumnRenamed("text_original", "text"))
    else:
        rows = anonymise(clean(fresh))
    if isinstance(rows.schema["datetime_utc"].dataType, T.StringType):
        rows = rows.withColumn("datetime_utc", lenient_timestamp(F.col("datetime_utc")))
    rows = rows.withColumn("cleaned_at", cleaned_at).withColumn("run_id", F.lit(run_id)).drop(*order_by)
    good, bad = split_valid(rows)
    return with_language_fallback(good, "text_original", detector=detector), bad


# --- gold -------------------------------------------------------------------------------------------------------------

def to_gold(silver: DataFrame, run_id: str, enriched_at: Column, parity_flags: bool = False,
            election: str = timefn.ELECTION_DATE) -> DataFrame:
    """Feature row per non-duplicate silver post. The three model columns stay NULL until scores are written back."""
    at = F.col("datetime_utc")
    flag = (lambda c: F.lit(False)) if parity_flags else (lambda c: F.coalesce(F.col(c), F.lit(False)))
    none = F.lit(None)
    return silver.where(~F.col("is_duplicate")).select(
        "id", "source", "datetime_utc",
        text.word_count(F.col("text_clean")).alias("word_count"), text.char_count(F.col("text_clean")).alias("char_count"),
        *[flag(c).alias(c) for c in ("has_hashtags", "has_emojis", "has_urls_original")],
        timefn.hour_of_day(at).alias("hour_of_day"), timefn.day_of_week(at).alias("day_of_week"),
        timefn.days_until(at, election).alias("days_until_election"),
        "engagement", scoring.engagement_score(F.col("engagement")).alias("engagement_score"),
        none.cast("string").alias("sentiment_label"), none.cast("double").alias("sentiment_score"),
        none.cast("string").alias("candidate_mentioned"),
        enriched_at.alias("enriched_at"), F.lit(run_id).alias("run_id"))


def with_model_results(gold: DataFrame, results: DataFrame) -> DataFrame:
    """Fill the model columns from (id, sentiment_label, sentiment_score, candidate_mentioned)."""
    slots = ["sentiment_label", "sentiment_score", "candidate_mentioned"]
    new = results.select("id", *[F.col(c).alias(f"_{c}") for c in slots])
    joined = gold.join(new, "id", "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in slots}).select(*gold.columns)


def candidate_slot(entities: str) -> Column:
    """All entities of a post as one text, NULL when there is none."""
    return F.nullif(F.array_join(entities, ", "), F.lit(""))


# --- analysis ---------------------------------------------------------------------------------------------------------

MIN_WORDS = 5


def standardise(posts: DataFrame, zone: str = timefn.LOCAL_ZONE, min_words: int = MIN_WORDS, **dictionaries) -> DataFrame:
    """Analysis rows of silver posts with at least ``min_words`` words of their own."""
    own = F.coalesce("text_clean", F.lit(""))
    rows = posts.withColumn("texto_usuario", own)
    rows = (
        text.once(rows, texto_usuario_norm=text.analysis_text(F.col("texto_usuario")))
        .where(text.word_count(F.col("texto_usuario_norm")) >= min_words)
        .withColumn("_context", text.context_text(F.col("metadata")))
        .withColumn("texto", text.with_context(F.col("texto_usuario"), F.col("_context")))
        .withColumn("texto_norm", text.analysis_text(F.col("texto")))
        .withColumn("fecha", timefn.local_time(F.col("datetime_utc"), zone))
        .withColumn("red", F.col("source"))
        .withColumn("engagement", scoring.network_engagement(F.col("source"), F.col("engagement")))
        .select("id", "texto", "texto_usuario", "texto_norm", "texto_usuario_norm", "red", "fecha", "engagement")
    )
    return with_entities(rows, "texto_norm", **dictionaries)


def with_intention(rows: DataFrame) -> DataFrame:
    """``rows`` of ``standardise``, whose texts are normalised already."""
    return rows.withColumn("intencion_explicita", stated_intention(F.col("texto_usuario_norm"), normalise=False))


def intention_share(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"), F.sum("intencion_explicita").alias("con_intencion"),
                    (F.avg(F.col("intencion_explicita").cast("double")) * 100).alias("porcentaje"))
