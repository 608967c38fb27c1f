"""Running values along keys of any length, maintained totals, and features of any number of entities."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import Window, functions as F

from agoralake.operators import feature_map as fm, feature_table as ft, scan, windows as wn
from agoralake.operators.asof import asof_join
from agoralake.plans import rollups, views
from agoralake.session import stored


def hot(spark, n=20_000, seed=3):
    r = random.Random(seed)
    start = dt.datetime(2026, 5, 1, 10)
    rows = [("hot" if r.random() < 0.9 else r.choice(["b", "c", None]), start + dt.timedelta(milliseconds=r.randrange(3_600_000)), i,
             r.randrange(100) if r.random() < 0.05 else None, "x") for i in range(n)]
    return spark.createDataFrame(rows, "k string, at timestamp, n long, v long, _c_last string")


def test_a_key_with_most_rows_in_one_hour_is_spread(spark):
    df = hot(spark)
    pieces = scan.in_pieces(df, ["k"], ["at", "n"], 8)
    sizes = [r["count"] for r in pieces.groupBy(scan.PIECE).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 0.25 * 20_000
    for inclusive in (True, False):
        got = scan.running(pieces, ["k"], ["at", "n"], {
            "last": ("last", "v"), "num": ("number", None), "total": ("sum", "v"), "bits": ("bit_xor", "n")}, inclusive)
        w = Window.partitionBy("k").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        want = df.select("n", F.last("v", True).over(w), F.count(F.lit(1)).over(w), F.sum("v").over(w), F.coalesce(F.bit_xor("n").over(w), F.lit(0)))
        rows = got.select("n", "last", F.coalesce("num", F.lit(0)), "total", "bits")
        assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert scan.running(scan.in_pieces(df.limit(0), ["k"], ["at"]), ["k"], ["at"], {"num": ("number", None)}).count() == 0


def test_fill_and_previous_equal_plain_windows(spark):
    df = hot(spark, 3000)
    w = Window.partitionBy("k").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, 0)
    key = lambda rows: sorted(map(tuple, rows), key=str)
    assert key(scan.fill_forward(df, ["v"], ["at", "n"], ["k"]).select("n", "v").collect()) == key(df.select("n", F.last("v", True).over(w)).collect())
    one = Window.orderBy("at", "n")
    assert key(scan.with_previous(df, {"p": "n"}, ["at", "n"]).select("n", "p").collect()) == key(df.select("n", F.lag("n").over(one)).collect())
    assert scan.fill_forward(df, ["v"], ["at", "n"]).columns == df.columns


def test_asof_scan_equals_the_blocked_join(spark):
    df = hot(spark, 4000)
    left = df.where("n % 2 = 0").select("k", "at", "n")
    right = df.where("n % 2 = 1").select("k", F.col("at").alias("rt"), F.col("n").alias("x")).where("k is not null")
    args = (["k"], "at", "rt", ["x"])
    key = lambda rows: sorted(map(tuple, rows), key=str)
    got, want = (f(left, right, *args).select("n", "x", "asof_rt") for f in (scan.asof_scan, asof_join))
    assert key(got.collect()) == key(want.collect()) and got.where("x is not null").count() > 1500
    assert scan.asof_scan(left, right.limit(0), *args).where("x is not null").count() == 0


def test_totals_follow_any_order_of_changes(spark, tmp_path):
    r = random.Random(5)
    label = ["positive", "negative", "neutral", None]
    rows = [(f"id{i}", r.choice(["twitter", "youtube"]), dt.datetime(2026, 5, r.randint(1, 5)), r.choice(label), r.choice([None, 0.1, -0.3])) for i in range(200)]
    schema = "id string, source string, datetime_utc timestamp, sentiment_label string, sentiment_score double"
    frame = lambda part: rollups.with_day(spark.createDataFrame(part, schema))
    view = rollups.sentiment_view(spark, str(tmp_path / "v"))
    view.apply("a", frame(rows[:150]))
    view.apply("b", frame(rows[150:]))
    state = dict((x[0], x) for x in rows)
    for step in range(3):
        old = [state[k] for k in r.sample(sorted(state), 20)]
        new = [(*x[:3], "neutral", 0.7) for x in old[:12]]
        for x in old:
            del state[x[0]]
        state.update((x[0], x) for x in new)
        for _ in range(2):
            view.apply(f"change{step}", frame(new), frame(old))
        if step == 1:
            view.fold()
            assert not view.apply("a", frame(rows)) and not view.apply("change0", frame(rows))
    want = {(x["day"], x["source"]): x for x in views.sentiment_daily(spark.createDataFrame(list(state.values()), schema)).collect()}
    got = {(x["day"], x["source"]): x for x in rollups.sentiment_daily(view.totals()).collect()}
    assert set(got) == set(want)
    for k, x in got.items():
        assert tuple(x)[:6] == tuple(want[k])[:6] and (x[6] is None) == (want[k][6] is None)
        assert x[6] is None or abs(x[6] - want[k][6]) < 1e-9
    assert view.batches() == {"a", "b", "change0", "change1", "change2"}


def test_feature_maps_hold_the_wide_tables_values(spark):
    day = dt.date(2026, 5, 1)
    rows = [(e, n, w, day, day, float(v)) for e, n, w, v in [
        ("Iván Cepeda", "twitter", 0, 1), ("Iván Cepeda", "youtube", 0, 3), ("Ana Diaz", "twitter", 0, 5), ("Ana Diaz", "twitter", 1, 7), (None, "twitter", 1, 9)]]
    scores = spark.createDataFrame(rows, "entidad string, red string, ventana int, fecha_ini_ventana date, fecha_fin_ventana date, score_final double")
    maps = fm.feature_maps(fm.score_features(scores, 1))
    got = {x["ventana"]: x["features"] for x in maps.collect()}
    assert got == {0: {"ST1_Iván Cepeda": 1.0, "SY1_Iván Cepeda": 3.0, "ST1_Ana Diaz": 5.0, "SP1_Iván Cepeda": 2.0, "SP1_Ana Diaz": 5.0},
                   1: {"ST1_Ana Diaz": 7.0, "SP1_Ana Diaz": 7.0}}
    table = {x["ventana"]: x for x in fm.wide(maps, ["ST1_Ana Diaz", "SP1_Nadie"], 0.0).collect()}
    assert table[1]["ST1_Ana Diaz"] == 7.0 and table[0]["SP1_Nadie"] == 0.0
    assert fm.feature_maps(fm.score_features(scores.limit(0), 1)).count() == 0


def test_scores_of_odd_posts_compute_them_once(spark, tmp_path):
    """With ``store`` the first day and the scores read stored rows; undated posts, posts without entities, null values and repeated rows count as before."""
    at = dt.datetime(2026, 5, 2)
    rows = [(None, ["a"], "twitter", 0.5, 1, 1.0, "x"), (at, ["a", None], "twitter", 0.5, 1, 3.0, "x"), (at, ["a"], None, -0.5, 0, None, None),
            (at, [], "twitter", 0.5, 0, 1.0, "x"), (at, None, "twitter", 0.5, 0, 1.0, "x"), (at + dt.timedelta(days=4), ["b"], "twitter", None, 0, 2.0, "x"),
            *[(at + dt.timedelta(days=4), ["a"], "youtube", 0.25, None, 2.0, "x")] * 2, (at - dt.timedelta(days=1), ["b"], "other", 0.1, 0, 0.0, "x")]
    schema = "fecha timestamp, candidatos array<string>, red string, score double, intencion_explicita int, engagement double, texto string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/posts")
    posts, seen = spark.read.parquet(f"{tmp_path}/posts"), []

    def store(df):
        seen.append(sorted(df.columns))
        return stored(df, "dated")

    for given in posts, posts.where("false"):
        out = wn.windowed_scores(given, "candidatos", store=store)
        assert not any(f"{tmp_path}/posts" in f for f in out.inputFiles())
        assert Counter(out.collect()) == Counter(wn.windowed_scores(given, "candidatos").collect())
    assert seen == [["candidatos", "engagement", "fecha", "intencion_explicita", "red", "score"]] * 2
    assert wn.windowed_scores(posts, "candidatos").count() == 6


def test_feature_means_share_one_exchange(spark):
    """Networks of one prefix, null networks and scores, and repeated rows; the scores are dealt out once for both means."""
    day = dt.date(2026, 5, 1)
    rows = [(e, n, w, day, day, v) for e, n, w, v in [
        ("a", "twitter", 0, 1.0), ("a", "twitter", 0, 1.0), ("a", "twitter", 0, 4.0), ("a", "nuevo", 0, 6.0), ("a", "NUEVO", 0, None), ("a", "youtube", 0, None),
        ("a", None, 0, 10.0), ("b", "otro", 0, None), ("b", "twitter", 1, 0.0), (None, "twitter", 1, 9.0), ("a", "twitter", None, 8.0)]]
    scores = spark.createDataFrame(rows, "entidad string, red string, ventana int, fecha_ini_ventana date, fecha_fin_ventana date, score_final double")
    named = fm.score_features(scores, 1)
    assert named.columns == [*ft.KEYS, "name", "value"]
    assert Counter((x["ventana"], x["name"], x["value"]) for x in named.collect()) == Counter([
        (0, "ST1_a", 2.0), (0, "NUEVO1_a", 6.0), (0, "SY1_a", None), (0, None, 10.0), (0, "SP1_a", 6.0),
        (0, "OTRO1_b", None), (0, "SP1_b", None), (1, "ST1_b", 0.0), (1, "SP1_b", 0.0), (None, "ST1_a", 8.0), (None, "SP1_a", 8.0)])
    first = fm.score_features(scores, 2, F.substring("entidad", 1, 0))  # one name for all
    assert {(x["ventana"], x["name"]): x["value"] for x in first.where("name = 'SP2_'").collect()} == {(0, "SP2_"): 6.0, (1, "SP2_"): 0.0, (None, "SP2_"): 8.0}
    plan = fm.feature_maps(named)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
