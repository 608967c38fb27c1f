"""Text expressions.

Character classes are written out (``\\p{L}`` for letters, an explicit list of spaces) because the short forms cover only
ASCII in Java while the data is Spanish, French and emoji-heavy.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agoralake import lexicon

# Unicode white space, word characters, and the patterns built from them.
SPACES = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD = r"\p{L}\p{N}_"
URL = rf"(?i)https?://[^{SPACES}]+|www\.[^{SPACES}]+"
MENTION = rf"@[{WORD}]+"
HASHTAG = rf"#[{WORD}]+"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2700}-\x{27BF}"
    r"\x{1F900}-\x{1FAFF}]"
)
# Anything these signs can be starts here, so most characters are settled by one comparison.
_MAYBE_EMOJI = r"[\x{2700}-\x{10FFFF}]"
SPACE_RUN = rf"[{SPACES}]+"
# The same white space as single characters, without the plain space.
OTHER_SPACES = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
    0x3000,
]))
# Holds all of them, and more: common characters are settled by one or two comparisons.
_MAYBE_SPACE = r"[^\x{20}-\x{7E}\x{A1}-\x{167F}]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it several times inside a CASE."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns by way of a one-row generator.

    A filter on a costly plain column is moved below it by the optimizer and computes it a second time; it cannot be
    moved below a generator.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def trim_spaces(c: Column) -> Column:
    """Strip any Unicode white space at both ends."""
    return F.btrim(c, F.lit(f" {OTHER_SPACES}"))


def _may_hold_url(c: Column) -> Column:
    """Quick test that every text with a link passes."""
    return F.contains(c, F.lit("://")) | c.rlike(r"[wW]{3}\.")


def strip_urls(c: Column) -> Column:
    return F.when(_may_hold_url(c), F.regexp_replace(c, URL, "")).otherwise(c)


def strip_mentions(c: Column) -> Column:
    return F.regexp_replace(c, MENTION, "")


def strip_hashtags(c: Column) -> Column:
    return F.regexp_replace(c, HASHTAG, "")


def plain_spaces(c: Column) -> Column:
    """Every white space as a plain space; most texts have no other one than line feeds."""
    return let(F.replace(c, F.lit("\n"), F.lit(" ")), lambda x: F.when(
        x.rlike(_MAYBE_SPACE), F.translate(x, OTHER_SPACES, " " * len(OTHER_SPACES))).otherwise(x))


def tidy(c: Column) -> Column:
    """Lower case, one space between words, none at the ends."""
    return F.trim(let(plain_spaces(F.lower(c)), lambda x: F.when(
        F.contains(x, F.lit("  ")), F.regexp_replace(x, " {2,}", " ")).otherwise(x)))


def has_url(c: Column) -> Column:
    return _may_hold_url(c) & c.rlike(URL)


def has_hashtag(c: Column) -> Column:
    return F.contains(c, F.lit("#")) & c.rlike(HASHTAG)


def has_emoji(c: Column) -> Column:
    return c.rlike(_MAYBE_EMOJI) & c.rlike(EMOJI)


def where_found(mark: str, raw: Column, change: Callable[[Column], Column], c: Column) -> Column:
    """Apply a pattern only to texts that hold the mark it needs; most do not, and the search for it is cheap."""
    return F.when(F.contains(raw, F.lit(mark)), change(c)).otherwise(c)


def clean_text(c: Column) -> Column:
    """Text without URLs, mentions and hashtags, tidied; emoji stay."""
    # URLs go first: one may hold '@' or '#'. Mentions and hashtags need two passes, as '#@a' shows.
    raw = F.coalesce(c, F.lit(""))
    return tidy(where_found("#", raw, strip_hashtags, where_found("@", raw, strip_mentions, strip_urls(raw))))


def normalized(c: Column) -> Column:
    """Struct of the cleaned text and the three flags of the raw text."""
    text = F.coalesce(c, F.lit(""))
    return F.struct(
        clean_text(c).alias("text_clean"),
        has_hashtag(text).alias("has_hashtags"),
        has_emoji(text).alias("has_emojis"),
        has_url(text).alias("has_urls_original"),
    )


def distinct_words(c: Column) -> Column:
    """Set of white-space separated words, lower case."""
    return F.array_remove(F.array_distinct(F.split(plain_spaces(F.lower(c)), " ")), "")


def detect_spanish(c: Column, keywords: Sequence[str] = lexicon.SPANISH_KEYWORDS, share: float = 0.10) -> Column:
    """``es`` when enough of the distinct words are Spanish function words, else ``unknown``; NULL for tiny texts."""
    known = F.array([F.lit(w) for w in keywords])

    def verdict(words: Column) -> Column:
        enough = F.size(F.array_intersect(words, known)) / F.greatest(F.size(words), F.lit(1)) >= F.lit(share)
        return F.when((F.size(words) > 0) & enough, F.lit("es")).otherwise(F.lit("unknown"))

    # Three characters or more between the outermost ones that are no space.
    return F.when(c.isNull() | ~c.rlike(rf"(?s)[^{SPACES}].+[^{SPACES}]"), F.lit(None)).otherwise(let(distinct_words(c), verdict))


def word_count(clean: Column) -> Column:
    """Words of a tidied text (single spaces only), without building an array."""
    spaces = F.length(clean) - F.length(F.replace(clean, F.lit(" "), F.lit("")))
    return F.when(F.coalesce(clean, F.lit("")) == "", F.lit(0)).otherwise(spaces + 1).cast("int")


def char_count(clean: Column) -> Column:
    return F.coalesce(F.length(clean), F.lit(0)).cast("int")


def repair_mojibake(c: Column) -> Column:
    """Undo UTF-8 text that was read as Latin-1; text that is not such a case is returned unchanged."""
    # The test keeps encode() away from characters outside Latin-1, which would raise.
    as_bytes = F.when(c.rlike(r"^[\x{00}-\x{FF}]*$"), F.encode(c, "ISO-8859-1"))
    return F.coalesce(F.try_validate_utf8(as_bytes.cast("string")), c)


_ACCENTED = "áéíóúàèìòùüñ"
_PLAIN = "aeiouaeiouun"


def analysis_text(c: Column) -> Column:
    """Plain lower-case words with single spaces: no links, signs, accents or punctuation."""
    raw = F.coalesce(c, F.lit(""))
    t = let(F.lower(raw), lambda x: F.when(
        F.contains(x, F.lit("http")) | F.contains(x, F.lit("@")) | F.contains(x, F.lit("#")),
        F.regexp_replace(x, rf"http[^{SPACES}]+|[@#]", "")).otherwise(x))
    t = let(t, lambda x: F.when(F.octet_length(x) > F.length(x), F.translate(x, _ACCENTED, _PLAIN)).otherwise(x))
    t = where_found("\u0301", raw, lambda x: F.regexp_replace(x, r"([aeiou])\x{301}", "$1"), t)
    return F.trim(F.regexp_replace(t, rf"[^{WORD}]+", " "))


def renormalized(analysis: Column) -> Column:
    """A second pass over already normalised text changes it only where dropping signs has formed a new link."""
    return F.when(F.contains(analysis, F.lit("http")), analysis_text(analysis)).otherwise(analysis)


# Metadata entries that give a post its context, in this order.
CONTEXT_KEYS = ["title", "video_title", "description", "desc", "hashtag", "tags"]


def context_text(metadata: Column, keys: Sequence[str] = CONTEXT_KEYS) -> Column:
    """Non-blank metadata entries joined by a space; empty text when there is none."""
    parts = [F.nullif(trim_spaces(F.try_element_at(metadata, F.lit(k))), F.lit("")) for k in keys]
    return F.concat_ws(" ", *parts)


def with_context(text: Column, context: Column) -> Column:
    return F.when(context != "", trim_spaces(F.concat_ws(" ", text, context))).otherwise(text)


def first_chars(c: Column, n: int = 400) -> Column:
    """The part of a text that a length-limited model reads."""
    return F.substring(F.coalesce(c, F.lit("")), 1, n)


# --- slugs, counts, links, names --------------------------------------------------------------------------------------

def first_name_slug(c: Column, limit: int | None = None) -> Column:
    word = F.split_part(F.trim(F.regexp_replace(c, SPACE_RUN, " ")), F.lit(" "), F.lit(1))
    return word if limit is None else F.substring(word, 1, limit)


def underscore_slug(c: Column, limit: int | None = None) -> Column:
    words = F.regexp_replace(trim_spaces(c), SPACE_RUN, "_")
    return words if limit is None else F.substring(words, 1, limit)


# Column-name prefix per network.
NETWORK_PREFIX = {"facebook": "SF", "youtube": "SY", "tiktok": "SX", "twitter": "ST"}


def network_prefix(source: Column) -> Column:
    out = F.upper(source)
    for name, prefix in NETWORK_PREFIX.items():
        out = F.when(source == name, F.lit(prefix)).otherwise(out)
    return out


_COUNT = r"([0-9]*\.?[0-9]+)[\s]*([KMB])?"


def social_count(c: Column) -> Column:
    """``1.2K`` -> 1200, ``3M`` -> 3000000, ``1,234`` -> 1234; no digits -> NULL."""
    t = F.replace(F.upper(F.trim(c)), F.lit(","), F.lit(""))
    number = F.nullif(F.regexp_extract(t, _COUNT, 1), F.lit("")).try_cast("double")
    unit = F.regexp_extract(t, _COUNT, 2)
    scale = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).otherwise(1.0)
    return (number * scale).try_cast("bigint")


def status_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/status/(\d+)", 1), F.lit(""))


def status_user(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/([^/]+)/status/\d+", 1), F.lit(""))


# Parts of a file name that tell its network, tried in this order.
FILE_NAME_HINTS = {
    "facebook": ["facebook", "fb_"],
    "tiktok": ["tiktok", "tk_"],
    "youtube": ["youtube", "yt_"],
    "twitter": ["tweet", "twitter", "tw_"],
}


def source_from_file_name(name: Column, hints: Mapping[str, Sequence[str]] = FILE_NAME_HINTS) -> Column:
    low = F.lower(name)
    cases = [(F.lit(False), None)]
    cases += [(F.contains(low, F.lit(h)), source) for source, parts in hints.items() for h in parts]
    out = F.when(cases[0][0], F.lit(None).cast("string"))
    for test, source in cases[1:]:
        out = out.when(test, F.lit(source))
    return out


def ensure_prefix(c: Column, prefix: str) -> Column:
    return F.when(F.startswith(c, F.lit(prefix)), c).otherwise(F.concat(F.lit(prefix), c))


def drop_first(c: Column, part: str) -> Column:
    """Remove the first occurrence of ``part``, wherever it stands."""
    return F.regexp_replace(c, rf"^((?s:.*?)){part}", "$1")
