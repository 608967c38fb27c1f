"""From exported rows of each source to the unified post: one projection per source, bad rows set aside."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Window, functions as F

from agoralake import schemas
from agoralake.functions.casting import lenient_int, text_or, text_or_null
from agoralake.functions.text import drop_first, ensure_prefix, trim_spaces
from agoralake.sources import files

_ORDER = ["file_path", "file_order"]
_HEADER = "file_header"


def _cell(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def _first_present(df: DataFrame, names: Sequence[str]) -> Column:
    """The first of these columns the row's own file has, whatever its cells hold."""
    if _HEADER not in df.columns:
        return _cell(df, next((n for n in names if n in df.columns), names[0]))
    out = F.lit(None).cast("string")
    for n in reversed([n for n in names if n in df.columns]):
        out = F.when(F.array_contains(_HEADER, n), F.col(f"`{n}`")).otherwise(out)
    return out


def _counts(df: DataFrame, fields: Mapping[str, str]) -> Column:
    pairs = [x for key, name in fields.items() for x in (F.lit(key), lenient_int(_cell(df, name)))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def _texts(df: DataFrame, fields: Mapping[str, str]) -> Column:
    pairs = [x for key, name in fields.items() for x in (F.lit(key), text_or_null(_cell(df, name)))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def _no_counts() -> Column:
    return F.create_map().cast(schemas.COUNTS)


def _post(df: DataFrame, *, id: Column, source: str, source_id: Column, at: Column, username: Column, text: Column,
          engagement: Column, metadata: Column, parent_id: Column | None = None, error: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(
        id.alias("id"), F.lit(source).alias("source"), source_id.alias("source_id"), at.alias("datetime_utc"),
        username.alias("username"), trim_spaces(text).alias("text"),
        (none if parent_id is None else parent_id).alias("parent_id"),
        engagement.cast(schemas.COUNTS).alias("engagement"), metadata.cast(schemas.TEXTS).alias("metadata"),
        *[F.col(c) for c in _ORDER if c in df.columns], (none if error is None else error).alias("_error"))


def map_twitter(df: DataFrame) -> DataFrame:
    key = F.replace(text_or(_cell(df, "id")), F.lit(".0"), F.lit(""))
    query = "Query" if "Query" in df.columns else "query"
    return _post(
        df, id=F.concat(F.lit("tw_"), key), source="twitter", source_id=key, at=text_or_null(_cell(df, "datetime")),
        username=text_or_null(_cell(df, "username")), text=text_or(_cell(df, "content")),
        engagement=_counts(df, {"replies": "replies", "retweets": "retweets", "likes": "likes"}),
        metadata=_texts(df, {"query": query}))


def map_youtube(df: DataFrame) -> DataFrame:
    raw = text_or(_cell(df, "id"))
    return _post(
        df, id=ensure_prefix(raw, "yt_"), source="youtube", source_id=drop_first(raw, "yt_"),
        at=text_or_null(_cell(df, "date")), username=text_or_null(_cell(df, "username")), text=text_or(_cell(df, "text")),
        parent_id=text_or_null(_cell(df, "parent_id")), engagement=_counts(df, {"likes": "likes", "views": "views"}),
        metadata=_texts(df, {"video_id": "video_id", "video_title": "video_title", "query": "query"}))


def map_tiktok(df: DataFrame) -> DataFrame:
    raw = text_or(_cell(df, "comment_id"))
    author = F.coalesce(text_or_null(_cell(df, "user_unique_id")), text_or_null(_cell(df, "user_nickname")))
    return _post(
        df, id=ensure_prefix(raw, "tk_"), source="tiktok", source_id=raw, at=text_or_null(_cell(df, "create_time")),
        username=author, text=text_or(_cell(df, "text")),
        engagement=_counts(df, {"likes": "digg_count", "replies": "reply_count"}),
        metadata=_texts(df, {"video_id": "video_id"}), error=F.when(raw == "", F.lit("comment_id missing")))


def _content_id(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat(*parts)), 1, 16)


# Metadata key <- column of the comment export.
FACEBOOK_METADATA = {
    "post_title": "titulo_post", "post_url": "url", "source_file": "archivo_origen",
    "candidates_detected": "candidatos_detectados", "detection_layer": "capa_deteccion",
}
NESTED_METADATA = {"post_title": "postTitle", "post_description": "postDescription", "post_url": "facebookUrl"}


def map_facebook(df: DataFrame) -> DataFrame:
    text, day = text_or(_cell(df, "comentario")), text_or(_cell(df, "fecha"))
    key = _content_id(text, day)
    return _post(
        df, id=F.concat(F.lit("fb_"), key), source="facebook", source_id=key, at=text_or_null(_cell(df, "fecha")),
        username=F.lit(None).cast("string"), text=text, engagement=_counts(df, {"likes": "likes"}),
        metadata=_texts(df, FACEBOOK_METADATA))


def map_facebook_nested(df: DataFrame) -> DataFrame:
    """Undated comments; a row whose text is only the link of its post is set aside."""
    text, url = text_or(_cell(df, "text")), text_or(_cell(df, "facebookUrl"))
    key = _content_id(text, url)
    link = F.startswith(text, F.lit("http://")) | F.startswith(text, F.lit("https://"))
    return _post(
        df, id=F.concat(F.lit("fb_"), key), source="facebook", source_id=key, at=F.lit(None).cast("string"),
        username=F.lit(None).cast("string"), text=text, engagement=_counts(df, {"likes": "likesCount"}),
        metadata=_texts(df, NESTED_METADATA), error=F.when(link, F.lit("post row without comment")))


# Accepted column names of a generic export, in order of preference.
EXTERNAL_TEXT = ["text", "content", "mensaje", "body"]
EXTERNAL_DATE = ["date", "datetime", "fecha"]
EXTERNAL_USER = ["username", "author", "usuario"]


def _with_row_ids(df: DataFrame) -> DataFrame:
    """``_row_id``: the digest of the bytes of a row's file, its position there and its cells.

    Equal rows differ in it, and a file read again, or under another name, gives the same ones. Rows that come from no scan
    of files have no position; there equal rows are counted through.
    """
    data = sorted(c for c in df.columns if c not in (*_ORDER, _HEADER))
    cells = F.to_json(F.struct(*[F.col(f"`{c}`") for c in data])) if data else F.lit("{}")
    scanned = [unquote(p) for p in df.inputFiles()] if set(_ORDER) <= set(df.columns) else []
    if scanned:
        hashed = files.fingerprints(df.sparkSession, scanned, F.col("_metadata.file_path")).withColumnsRenamed(
            {"file_path": "_file", "source_sha256": "_sha256"})
        placed = files.with_row_numbers(df, "_row").join(hashed, F.col("file_path") == F.col("_file"), "left")
        own = F.concat_ws("\n", F.coalesce("_sha256", "file_path"), F.col("_row").cast("string"), cells)
        return placed.withColumn("_row_id", F.sha2(own, 256)).drop("_row", "_file", "_sha256")
    path = F.coalesce(F.col("file_path"), F.lit("")) if "file_path" in df.columns else F.lit("")
    alike = df.withColumn("_alike", F.sha2(F.concat_ws("\n", path, cells), 256))
    turn = F.row_number().over(Window.partitionBy("_alike").orderBy(F.lit(1)))
    return alike.withColumn("_row_id", F.sha2(F.concat_ws("\n", F.col("_alike"), turn.cast("string")), 256)).drop("_alike")


def map_external(df: DataFrame) -> DataFrame:
    """Generic export. Rows without an id all stay: each gets an id of its own, which a retry gives again."""
    given = text_or(_cell(df, "id"))
    rest = _with_row_ids(df).where(given == "")
    return _external_posts(df.where(given != ""), given).unionByName(_external_posts(rest, F.col("_row_id")))


def _external_posts(df: DataFrame, raw: Column) -> DataFrame:
    return _post(
        df, id=ensure_prefix(raw, "ext_"), source="other", source_id=drop_first(raw, "ext_"),
        at=text_or_null(_first_present(df, EXTERNAL_DATE)), username=text_or_null(_first_present(df, EXTERNAL_USER)),
        text=text_or(_first_present(df, EXTERNAL_TEXT)), engagement=_no_counts(),
        metadata=F.create_map(F.lit("import_source"), F.lit("external_csv")))


MAPPERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "twitter": map_twitter,
    "youtube": map_youtube,
    "tiktok": map_tiktok,
    "facebook": map_facebook,
    "fb_parlamentarias": map_facebook_nested,
    "external": map_external,
}


def with_valid_source(df: DataFrame) -> DataFrame:
    """Lower-case the source; an unknown one is an error."""
    low = F.lower("source")
    bad = F.when(~F.coalesce(low.isin(schemas.SOURCES), F.lit(False)), F.lit("source unknown"))
    return df.withColumn("source", low).withColumn("_error", F.coalesce(F.col("_error"), bad))


def map_posts(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(posts, rejected) for one source. An unknown source has no posts."""
    mapper = MAPPERS.get(source)
    if mapper is None:
        empty = _external_posts(df, F.lit("")).where(F.lit(False))
        return empty.drop("_error"), empty.withColumnRenamed("_error", "error")
    mapped = with_valid_source(mapper(df))
    good = mapped.where(F.col("_error").isNull()).drop("_error")
    bad = mapped.where(F.col("_error").isNotNull()).withColumnRenamed("_error", "error")
    return good, bad


def raw_rows(posts: DataFrame, run_id: str, ingested_at: Column, storage_path: Column | None = None,
             sha256: Column | None = None) -> DataFrame:
    """Rows of the raw table: keys plus the post as a payload struct."""
    file_name = F.element_at(F.split(F.col("file_path"), "/"), -1) if "file_path" in posts.columns else F.lit("")
    stored = F.concat(F.lit("local://processed/"), file_name) if storage_path is None else storage_path
    return posts.select(
        "id", "source", "source_id", stored.alias("storage_path"), ingested_at.alias("ingested_at"),
        F.lit(run_id).alias("run_id"),
        F.struct("datetime_utc", "username", "text", "parent_id", "engagement", "metadata").alias("raw_payload"),
        (F.lit(None).cast("string") if sha256 is None else sha256).alias("source_sha256"),
        (F.col("file_order") if "file_order" in posts.columns else F.lit(0).cast("bigint")).alias("seq"))


def posts_of_raw(raw: DataFrame) -> DataFrame:
    """The posts inside raw rows; missing parts get their defaults."""
    p = lambda name: F.col(f"raw_payload.{name}")
    return raw.select(
        "id", "source", "source_id", p("datetime_utc").alias("datetime_utc"), p("username").alias("username"),
        trim_spaces(F.coalesce(p("text"), F.lit(""))).alias("text"), p("parent_id").alias("parent_id"),
        F.coalesce(p("engagement"), _no_counts()).alias("engagement"),
        F.coalesce(p("metadata"), F.create_map().cast(schemas.TEXTS)).alias("metadata"), "seq")


def posts_of_json(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The same from a payload kept as JSON text."""
    return posts_of_raw(df.withColumn("raw_payload", F.from_json(F.col(payload), schemas.PAYLOAD)))


def aligned_append(existing: DataFrame, new: DataFrame, column: str = "Query") -> DataFrame:
    """Append rows to a table whose key column may be spelled in another case or be missing; column order is kept."""
    spelled = next((c for c in existing.columns if c.lower() == column.lower()), None)
    if spelled is None:
        existing = existing.withColumn(column, F.lit(""))
    elif spelled != column:
        existing = existing.withColumnRenamed(spelled, column)
    return existing.unionByName(new, allowMissingColumns=True).select(*existing.columns)


def anonymised_export(df: DataFrame, key: str, drop: Sequence[str], hash_ids: Sequence[str],
                      order_by: Sequence[str]) -> DataFrame:
    """An export without names, with hashed user ids and one row per key; rows without a key all stay."""
    from agoralake.functions.pii import hashed_id
    from agoralake.operators.dedupe import dedupe
    df = df.drop(*drop).withColumns({c: hashed_id(F.col(c)) for c in hash_ids if c in df.columns})
    return dedupe(df, [key], order_by, keep="first", keep_null_keys=True)
