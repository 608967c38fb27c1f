"""Masking of personal data: e-mail addresses, phone numbers, identity numbers, and identity fields of metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from agoralake.functions.text import SPACES, WORD

# Patterns, place holders and identity keys.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
# Each begins with a test of the one character a match can start with, as most positions start none.
PHONE = (
    rf"(?=[+(\p{{Nd}}])(?:\+57[{SPACES}]?)?(?:\(?\p{{Nd}}{{1,3}}\)?[{SPACES}.-]?)?\p{{Nd}}{{3}}[{SPACES}.-]?\p{{Nd}}{{4}}"
)
ID_NUMBER = rf"(?=\p{{Nd}})(?<![{WORD}])\p{{Nd}}{{8,10}}(?![{WORD}])"
IDENTITY_KEYS = ["user_nickname", "author_nickname", "username", "channel_name"]
LEAK_KEYS = [
    "username", "user_name", "user_nickname", "nickname", "user_unique_id", "user_id", "author", "author_name",
    "screen_name", "handle", "display_name", "usuario",
]


def mask_email(c: Column) -> Column:
    # The pattern retries at every letter of a long word, so texts without an '@' are spared.
    return F.when(F.contains(c, F.lit("@")), F.regexp_replace(c, EMAIL, "[EMAIL]")).otherwise(c)


def mask_phone(c: Column) -> Column:
    return F.when(c.rlike(r"\p{Nd}{4}"), F.regexp_replace(c, PHONE, "[PHONE]")).otherwise(c)


def mask_id_number(c: Column) -> Column:
    return F.when(c.rlike(r"\p{Nd}{8}"), F.regexp_replace(c, ID_NUMBER, "[CEDULA]")).otherwise(c)


def masked(c: Column) -> Column:
    return mask_id_number(mask_phone(mask_email(F.coalesce(c, F.lit("")))))


def with_masking(df: DataFrame, column: str) -> DataFrame:
    """Mask ``column`` in place and add ``pii_detected`` and ``pii_types``.

    The order matters: phones go before identity numbers and take every run of seven digits or more. A type is reported
    when its pass changed the text, so each pattern runs once.
    """
    steps = df.withColumn("_raw", F.coalesce(F.col(column), F.lit("")))
    for name, step, prior in (("_email", mask_email, "_raw"), ("_phone", mask_phone, "_email"),
                              ("_idnum", mask_id_number, "_phone")):
        steps = steps.withColumn(name, step(F.col(prior)))
    types = F.array_compact(F.array(
        F.when(F.col("_email") != F.col("_raw"), F.lit("email")),
        F.when(F.col("_phone") != F.col("_email"), F.lit("phone")),
        F.when(F.col("_idnum") != F.col("_phone"), F.lit("cedula")),
    ))
    return (
        steps.withColumn(column, F.col("_idnum"))
        .withColumn("pii_types", types)
        .withColumn("pii_detected", F.col("_idnum") != F.col("_raw"))
        .drop("_raw", "_email", "_phone", "_idnum")
    )


def exposes_pii(c: Column) -> Column:
    """True when a text still shows an e-mail address, a phone or an identity number."""
    text = F.coalesce(c, F.lit(""))
    return (F.contains(text, F.lit("@")) & text.rlike(EMAIL)) | text.rlike(r"\p{Nd}{4}") & (text.rlike(PHONE) | text.rlike(ID_NUMBER))


def without_keys(m: Column, keys: list[str] = IDENTITY_KEYS) -> Column:
    return F.map_filter(m, lambda k, _: ~k.isin(keys))


def has_any_key(m: Column, keys: list[str] = LEAK_KEYS) -> Column:
    """Case-insensitive test for any of the keys."""
    return F.coalesce(F.exists(F.map_keys(m), lambda k: F.lower(k).isin(keys)), F.lit(False))


def hashed_id(c: Column) -> Column:
    return F.when(c.isNull() | (c == ""), F.lit(None)).otherwise(F.sha2(c, 256))
