"""Table schemas of the three layers, the media tables and the run ledger."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, TS, DT = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType(), T.DateType(),
)
COUNTS = T.MapType(S, L)
TEXTS = T.MapType(S, S)

# The networks a post may come from.
SOURCES = ["twitter", "youtube", "facebook", "tiktok", "other"]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PAYLOAD = _struct(datetime_utc=S, username=S, text=S, parent_id=S, engagement=COUNTS, metadata=TEXTS)

BRONZE_POST = _struct(
    id=S, source=S, source_id=S, datetime_utc=S, username=S, text=S, parent_id=S,
    engagement=COUNTS, metadata=TEXTS, ingested_at=TS,
)

RAW_POST = _struct(
    id=S, source=S, source_id=S, storage_path=S, ingested_at=TS, run_id=S, raw_payload=PAYLOAD, source_sha256=S, seq=L,
)

SILVER_POST = _struct(
    id=S, source=S, source_id=S, datetime_utc=TS, author_id=S, text_clean=S, text_original=S, parent_id=S,
    engagement=COUNTS, metadata=TEXTS, lang=S, pii_detected=B, pii_types=T.ArrayType(S), is_duplicate=B,
    has_hashtags=B, has_emojis=B, has_urls_original=B, cleaned_at=TS, run_id=S,
)

GOLD_FEATURE = _struct(
    id=S, source=S, datetime_utc=TS, word_count=I, char_count=I, has_hashtags=B, has_emojis=B, has_urls_original=B,
    hour_of_day=I, day_of_week=I, days_until_election=I, engagement=COUNTS, engagement_score=D,
    sentiment_label=S, sentiment_score=D, candidate_mentioned=S, enriched_at=TS, run_id=S,
)

YOUTUBE_VIDEO = _struct(
    video_id=S, title=S, channel=S, channel_id=S, description=S, published_at=TS, view_count=L, like_count=L,
    comment_count=L, duration=I, tags=S, query=S, collected_at=TS, run_id=S,
)

TIKTOK_VIDEO = _struct(
    video_id=S, hashtag=S, create_time=TS, author_unique_id=S, author_nickname=S, description=S, play_count=L,
    digg_count=L, comment_count=L, share_count=L, video_duration=I, run_id=S,
)

MENTIONS = _struct(
    article_id=S, url=S, medio=S, fecha=DT, titulo=S, candidato=S, menciones=I, titulo_flag=B, evento_tipo=S, region=S,
)

SHARE_OF_VOICE = _struct(
    fecha=DT, medio=S, candidato=S, menciones=I, share_of_voice=T.DecimalType(8, 6),
    rolling_7=T.DecimalType(10, 4), momentum=T.DecimalType(10, 4),
)

VOTE_INTENTIONS = _struct(
    article_id=S, url=S, medio=S, fecha=DT, titulo=S, candidato=S, candidato_raw=S,
    porcentaje=T.DecimalType(6, 2), encuestadora=S, contexto=S,
)

SCORE_WINDOW = _struct(
    entidad=S, red=S, ventana=I, fecha_ini_ventana=DT, fecha_fin_ventana=DT,
    score_final=D, score_promedio=D, menciones=L, engagement_total=D,
)

CHECK = _struct(check=S, status=S, reason=S, detail=TEXTS)

QUALITY_REPORT = _struct(run_id=S, layer=S, overall=S, total_records=L, checks=T.ArrayType(CHECK), created_at=TS)

RUN = _struct(
    run_id=S, flow_name=S, status=S, started_at=TS, finished_at=TS, rows_in=L, rows_out=L, quality_summary=TEXTS, error=S,
)

POLLS = _struct(fecha=DT, encuestadora=S, candidato=S, intencion_voto=D)

# Header columns of the exported files, per source (all read as text).
TWITTER_CSV = ["id", "Query", "datetime", "username", "content", "replies", "retweets", "likes"]
YOUTUBE_CSV = ["id", "parent_id", "date", "text", "username", "likes", "views", "video_id", "video_title", "query",
               "source_type"]
TIKTOK_CSV = ["video_id", "comment_id", "create_time", "user_unique_id", "user_nickname", "text", "digg_count",
              "reply_count"]
FACEBOOK_CSV = ["titulo_post", "descripcion_post", "comentario", "comentario_clean", "comentario_norm", "likes", "url",
                "fecha", "archivo_origen", "candidatos_detectados", "capa_deteccion"]
NESTED_CSV = ["postTitle", "postDescription", "text", "likesCount", "facebookUrl"]
EXTERNAL_CSV = ["id", "text", "date", "username"]
YOUTUBE_VIDEO_CSV = ["video_id", "title", "channel", "channel_id", "description", "published_at", "view_count",
                     "like_count", "comment_count", "duration", "tags", "query", "collected_at"]
TIKTOK_VIDEO_CSV = ["video_id", "hashtag", "create_time", "author_unique_id", "author_nickname", "desc", "play_count",
                    "digg_count", "comment_count", "share_count", "video_duration"]

COMMENT_CSV = {
    "twitter": TWITTER_CSV, "youtube": YOUTUBE_CSV, "tiktok": TIKTOK_CSV, "facebook": FACEBOOK_CSV,
    "external": EXTERNAL_CSV, "fb_parlamentarias": NESTED_CSV,
}
VIDEO_CSV = {"youtube": YOUTUBE_VIDEO_CSV, "tiktok": TIKTOK_VIDEO_CSV}


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, S) for c in columns])
