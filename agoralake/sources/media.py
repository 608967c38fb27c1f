"""Press-monitoring tables and video metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from agoralake import schemas
from agoralake.functions.casting import (
    blank_to_null, first_ten_as_date, lenient_double, lenient_int, lenient_timestamp, text_or_null,
)
from agoralake.operators.dedupe import dedupe

MENTION_KEYS = ["article_id", "candidato"]
VOICE_KEYS = ["fecha", "medio", "candidato"]


def _cell(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _key(df: DataFrame, name: str) -> Column:
    return F.trim(F.coalesce(_cell(df, name), F.lit("")))


def mentions(df: DataFrame) -> DataFrame:
    """One row per article and candidate; a missing count is 1, a missing flag is false, rows without keys go."""
    rows = df.select(
        _key(df, "article_id").alias("article_id"), text_or_null(_cell(df, "url")).alias("url"),
        _key(df, "medio").alias("medio"), first_ten_as_date(_cell(df, "fecha")).alias("fecha"),
        text_or_null(_cell(df, "titulo")).alias("titulo"), _key(df, "candidato").alias("candidato"),
        lenient_int(_cell(df, "menciones"), 1).alias("menciones"),
        (lenient_int(_cell(df, "titulo_flag"), 0) != 0).alias("titulo_flag"),
        text_or_null(_cell(df, "evento_tipo")).alias("evento_tipo"), text_or_null(_cell(df, "region")).alias("region"))
    return _typed(rows.where((F.col("article_id") != "") & (F.col("candidato") != "")), schemas.MENTIONS)


def vote_intentions(df: DataFrame) -> DataFrame:
    rows = df.select(
        _key(df, "article_id").alias("article_id"), text_or_null(_cell(df, "url")).alias("url"),
        _key(df, "medio").alias("medio"), first_ten_as_date(_cell(df, "fecha")).alias("fecha"),
        text_or_null(_cell(df, "titulo")).alias("titulo"), _key(df, "candidato").alias("candidato"),
        text_or_null(_cell(df, "candidato_raw")).alias("candidato_raw"),
        lenient_double(_cell(df, "porcentaje")).alias("porcentaje"),
        text_or_null(_cell(df, "encuestadora")).alias("encuestadora"),
        text_or_null(_cell(df, "contexto")).alias("contexto"))
    return _typed(rows.where((F.col("article_id") != "") & (F.col("candidato") != "")), schemas.VOTE_INTENTIONS)


def _voice(df: DataFrame, *extra: str) -> DataFrame:
    order = F.col("file_order") if "file_order" in df.columns else F.lit(0).cast("bigint")
    return df.select(
        first_ten_as_date(_cell(df, "fecha")).alias("fecha"), _key(df, "medio").alias("medio"),
        _key(df, "candidato").alias("candidato"), lenient_int(_cell(df, "menciones")).cast("int").alias("menciones"),
        lenient_double(_cell(df, "share_of_voice")).alias("share_of_voice"),
        *[lenient_double(_cell(df, c)).alias(c) for c in extra], order.alias("file_order"))


def momentum(df: DataFrame) -> DataFrame:
    return _typed(_voice(df, "rolling_7", "momentum"), schemas.SHARE_OF_VOICE)


def merge_voice(voice: DataFrame, moving: DataFrame | None) -> DataFrame:
    """Full outer merge on (fecha, medio, candidato).

    Where the left table has a key its counts stand; the right table's counts serve only keys of its own. Rolling figures
    always come from the right. The last of several equal keys wins on either side.
    """
    left = dedupe(voice, VOICE_KEYS, ["file_order"]).select(
        *VOICE_KEYS, F.struct("menciones", "share_of_voice").alias("_l"))
    if moving is None:
        return left.select(*VOICE_KEYS, "_l.*", F.lit(None).cast("double").alias("rolling_7"),
                           F.lit(None).cast("double").alias("momentum"))
    right_rows = dedupe(moving, VOICE_KEYS, ["file_order"]).select(
        *VOICE_KEYS, F.struct("menciones", "share_of_voice").alias("_r"), "rolling_7", "momentum")
    # Several right rows of a key unknown on the left: the first sets the counts, the last sets the rolling figures.
    first_counts = dedupe(moving, VOICE_KEYS, ["file_order"], keep="first").select(
        *VOICE_KEYS, F.struct("menciones", "share_of_voice").alias("_r0"))
    merged = left.join(right_rows.join(first_counts, VOICE_KEYS), VOICE_KEYS, "full")
    pick = lambda c: F.when(F.col("_l").isNotNull(), F.col(f"_l.{c}")).otherwise(F.col(f"_r0.{c}")).alias(c)
    return merged.select(*VOICE_KEYS, pick("menciones"), pick("share_of_voice"), "rolling_7", "momentum")


def share_of_voice(sov: DataFrame, moving: DataFrame | None = None) -> DataFrame:
    merged = merge_voice(_voice(sov), None if moving is None else _voice(moving, "rolling_7", "momentum"))
    return _typed(merged, schemas.SHARE_OF_VOICE)


# --- videos -----------------------------------------------------------------------------------------------------------

_AS_TIME = {"published_at", "collected_at", "create_time"}


def _video(df: DataFrame, schema, run_id: str, renamed: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    def cell(name: str, kind) -> Column:
        if name == "run_id":
            return F.lit(run_id)
        if name in renamed:
            return renamed[name]
        if name in _AS_TIME:
            return lenient_timestamp(_cell(df, name))
        return blank_to_null(_cell(df, name)) if kind == schemas.S else lenient_int(_cell(df, name)).try_cast(kind)
    order = [F.col(c) for c in ("file_path", "file_order") if c in df.columns]
    rows = df.select(*[cell(f.name, f.dataType).alias(f.name) for f in schema.fields], *order)
    return rows.where(F.col("video_id").isNotNull()), rows.where(F.col("video_id").isNull())


def youtube_videos(df: DataFrame, run_id: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rows without an id)."""
    return _video(df, schemas.YOUTUBE_VIDEO, run_id, {})


def tiktok_videos(df: DataFrame, run_id: str) -> tuple[DataFrame, DataFrame]:
    shown = F.coalesce(F.nullif(_cell(df, "desc"), F.lit("")), _cell(df, "description"))
    return _video(df, schemas.TIKTOK_VIDEO, run_id, {"description": blank_to_null(shown)})


VIDEO_MAPPERS = {"youtube": youtube_videos, "tiktok": tiktok_videos}
VIDEO_SCHEMAS = {"youtube": schemas.YOUTUBE_VIDEO, "tiktok": schemas.TIKTOK_VIDEO}
