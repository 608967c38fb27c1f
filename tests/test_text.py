import datetime as dt
import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from agoralake.functions import casting, pii, scoring, text, timefn


def test_clean_text(one):
    got = one(text.clean_text, "hola @niño_x fin", "Mira HTTPS://a.b/c?d #Voto2026  ya", "  www.x.co   Ñandú OK ", None,
              "sin nada 😀")
    assert got == ["hola fin", "mira ya", "ñandú ok", "", "sin nada 😀"]


def test_flags(one):
    assert one(text.has_emoji, "hola 😀", "hola", "✂ x") == [True, False, True]
    assert one(text.has_hashtag, "#año", "# x", "a#b") == [True, False, True]
    assert one(text.has_url, "ve www.x.co", "WWW.x.co", "wwwx") == [True, True, False]


def test_spanish(one):
    got = one(text.detect_spanish, "el gobierno de la nación", "hello my dear friend of mine", "ab", None, "   ", "   x   ")
    assert got == ["es", "unknown", None, None, None, None]
    # one keyword in ten distinct words is just enough
    assert one(text.detect_spanish, "de a1 a2 a3 a4 a5 a6 a7 a8 a9", "de a1 a2 a3 a4 a5 a6 a7 a8 a9 b1") == ["es", "unknown"]


def test_counts(one):
    assert one(text.word_count, "a b c", "", None, "uno") == [3, 0, 0, 1]
    assert one(text.char_count, "a 😀", "", None) == [3, 0, 0]


def test_phone_and_id_numbers(one):
    got = one(pii.masked, "1234567", "12345678", "1234567890", "12345678901", "600123", "tel +57 300 123 4567 y 1",
              "escribe a ana.b@x.co ya")
    assert got == ["[PHONE]", "[PHONE]", "[PHONE]", "[PHONE]1", "600123", "tel [PHONE] y 1", "escribe a [EMAIL] ya"]


def test_masking_reports_types(spark):
    df = spark.createDataFrame([("a@b.co 3001234567",), ("nada",), (None,)], "t string")
    rows = [tuple(r) for r in pii.with_masking(df, "t").select("t", "pii_types", "pii_detected").collect()]
    assert rows == [("[EMAIL] [PHONE]", ["email", "phone"], True), ("nada", [], False), ("", [], False)]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="0123456789 ab@.+-()ñ😀", max_size=40), min_size=1, max_size=30))
def test_masking_is_idempotent_and_leaves_nothing(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(pii.masked(F.col("t")).alias("m"))
    rows = df.select("m", pii.masked(F.col("m")).alias("again"), pii.exposes_pii(F.col("m")).alias("leak")).collect()
    assert all(r["m"] == r["again"] and not r["leak"] for r in rows)


def test_mojibake(one):
    broken = "prÃ³ximo aÃ±o"
    assert one(text.repair_mojibake, broken, "próximo", "plain", "日本 Ã³", None, "") == [
        "próximo año", "próximo", "plain", "日本 Ã³", None, ""]


def test_analysis_text(one):
    got = one(text.analysis_text, "¡Así, SÍ! @Petro #YA http://x.y z", "árbol ñu_1", None, "é́x")
    assert got == ["asi si petro ya z", "arbol nu_1", "", "e x"]


def test_second_normalisation_only_matters_for_new_links(one):
    twice = lambda c: text.renormalized(text.analysis_text(c))
    full = lambda c: text.analysis_text(text.analysis_text(c))
    values = ["ht@tpfoo bar", "ya http://x.y", "http", "sin enlace"]
    assert one(twice, *values) == one(full, *values)


def test_context(spark):
    df = spark.createDataFrame([({"tags": " t ", "title": "T", "desc": "  ", "otro": "x"},), ({},)], "m map<string,string>")
    rows = df.select(text.context_text(F.col("m")).alias("c"), text.with_context(F.lit("hola"), text.context_text(F.col("m"))).alias("w"))
    assert [tuple(r) for r in rows.collect()] == [("T t", "hola T t"), ("", "hola")]


def test_small_parsers(one):
    assert one(text.social_count, "1.2K", "3M", "1,234", "", None, "2b", "x", ".5k") == [
        1200, 3000000, 1234, None, None, 2000000000, None, 500]
    assert one(timefn.iso_duration_seconds, "PT1H2M3S", "bad", None, "PT5M", "PT") == [3723, 0, 0, 300, 0]
    assert one(text.status_id, "https://x/u/status/12?s=1", "https://x/u", None) == ["12", None, None]
    assert one(text.status_user, "https://x/u/status/12?s=1", "/status/1", None) == ["u", None, None]
    assert one(text.source_from_file_name, "Tweets_co.csv", "run_fb_1.csv", "yt_x", "otro.csv") == [
        "twitter", "facebook", "youtube", None]
    assert one(lambda c: text.drop_first(c, "yt_"), "yt_a", "a_yt_b_yt_", "x") == ["a", "a_b_yt_", "x"]
    assert one(lambda c: text.first_name_slug(c, 15), "Abelardo De la Espriella", "  x  y ") == ["Abelardo", "x"]
    assert one(lambda c: text.underscore_slug(c, 20), "Defensores de la  Patria") == ["Defensores_de_la_Pat"]
    assert one(lambda c: text.first_chars(c, 3), "abcdef", "a", None) == ["abc", "a", ""]


def test_casts(one):
    assert one(casting.lenient_int, "12.7", "-12.7", "nan", "", "x", " 5 ", "1e3", "1d", "inf", None) == [
        12, -12, None, None, None, 5, 1000, None, None, None]
    assert one(casting.text_or_null, "nan", "None", "", " ", "NA") == [None, None, None, " ", "NA"]
    assert one(casting.blank_to_null, " ", "nan ", " a") == [None, None, " a"]
    utc = lambda *a: dt.datetime(*a)
    assert one(casting.lenient_timestamp, "2026-05-08T12:00:00Z", "2026-05-08 12:00:00", "2026-05-08T12:00:00-05:00",
               "2026-05-08", "ayer", "2026", "") == [
        utc(2026, 5, 8, 12), utc(2026, 5, 8, 12), utc(2026, 5, 8, 17), utc(2026, 5, 8), None, None, None]


def test_calendar(one):
    at = lambda c: c.cast("timestamp")
    assert one(lambda c: timefn.days_until(at(c)), "2026-06-01 10:00:00", "2026-05-30 23:00:00", "2026-05-31") == [-2, 1 - 1, 0]
    assert one(lambda c: timefn.day_of_week(at(c)), "2026-05-31", "2026-06-01") == [6, 0]
    origin = F.lit("2026-01-01").cast("date")
    assert one(lambda c: timefn.window_index(c.cast("date"), origin), "2026-01-03", "2026-01-04", "2025-12-31") == [0, 1, -1]


def test_engagement(spark):
    df = spark.createDataFrame([({"likes": 50},), ({},), ({"otro": 1},), ({"views": 100, "replies": 1},)], "m map<string,bigint>")
    got = [r[0] for r in df.select(scoring.engagement_score(F.col("m"))).collect()]
    assert got == [3.9318, None, None, round(math.log1p(4.0), 4)]


def test_scores(one):
    assert one(scoring.label_sign, "pos", "LABEL_0", "NEU", None) == [1.0, -1.0, 0.0, 0.0]
    assert one(scoring.sentiment_class, 0.1, 0.11, -0.2, kind="double") == ["neutro", "positivo", "negativo"]
    assert one(lambda c: scoring.composite_score(c, F.lit(1)), 0.9, -1.0, kind="double") == [1.0, -0.7]
    assert one(scoring.log_weight, -5.0, None, kind="double") == [1.0, 1.0]


def test_guards_and_short_forms_keep_every_character(one):
    spaces = " " + text.OTHER_SPACES
    assert one(text.trim_spaces, spaces + "a b" + spaces, "a\n", spaces, "") == ["a b", "a", "", ""]
    assert one(text.tidy, "".join(f"X{s}" for s in spaces), "​A⁠ \x00  B") == [" ".join("x" * len(spaces)), "​a⁠ \x00 b"]
    assert one(text.strip_urls, "ftp://a http://b c", "WwW.a b", "www a", "https:// a") == ["ftp://a  c", " b", "www a", "https:// a"]
    assert one(text.analysis_text, "Ñ@ndú", "xhttp://a ñ", "á b") == ["nndu", "x n", "a b"]
    assert one(pii.masked, "(300) ١٢٣ ٤٥٦٧", "+57 1234567", "12-34", "2026") == ["[PHONE]", "[PHONE]", "12-34", "2026"]
    assert one(pii.exposes_pii, "x 123-4567", "123 456", "1234") == [True, False, False]


def test_trimming_needs_no_pattern(spark):
    plan = spark.range(1).select(text.trim_spaces(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "regexp" not in plan  # a pattern anchored at the end tries every space of a long text
