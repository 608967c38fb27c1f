import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from agoralake.operators import asof, feature_table as ft, forecast as fc, windows as wn

D = lambda n: dt.date(2026, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def polls(spark):
    rows = [(D(4), "I", "A", 0.2), (D(4), "J", "A", 0.4), (D(4), "I", "B", 0.3), (D(10), "I", "A", 0.5), (D(20), "I", "C", 0.1)]
    return spark.createDataFrame(rows, "fecha date, encuestadora string, candidato string, intencion_voto double")


@pytest.fixture
def windows(spark):
    rows = [(i, D(3 * i), D(3 * i + 2)) for i in range(9)]
    return spark.createDataFrame(rows, "ventana int, fecha_ini_ventana date, fecha_fin_ventana date")


def test_poll_in_force(polls, windows):
    got = {r["ventana"]: r["fecha"] for r in ft.poll_date_of_window(windows, polls).collect()}
    # the first two windows start before every poll and take the first one
    assert got == {0: D(4), 1: D(4), 2: D(4), 3: D(4), 4: D(10), 5: D(10), 6: D(10), 7: D(20), 8: D(20)}


def test_levels_are_carried_forward(polls):
    names = ["A", "B", "C"]
    got = {(r["fecha"], r["candidato"]): r["nivel"] for r in fc.carried_levels(polls, names).collect()}
    third = 1 / 3
    want = {(D(4), "A"): 0.3, (D(4), "B"): 0.3, (D(4), "C"): third, (D(10), "A"): 0.5, (D(10), "B"): 0.3, (D(10), "C"): third,
            (D(20), "A"): 0.5, (D(20), "B"): 0.3, (D(20), "C"): 0.1}
    assert got == pytest.approx(want)


def test_targets_equal_numpy(polls, windows):
    names = ["A", "B", "C"]
    level = np.array([[0.3, 0.3, 1 / 3], [0.5, 0.3, 1 / 3], [0.5, 0.3, 0.1]])
    level /= level.sum(axis=1, keepdims=True)
    delta = np.vstack([level[0] - 1 / 3, np.diff(level, axis=0)])
    soft = np.exp(delta / 0.3) / np.exp(delta / 0.3).sum(axis=1, keepdims=True)
    mix = 0.75 * level + 0.25 * soft
    mix /= mix.sum(axis=1, keepdims=True)
    poll_of = [0, 0, 0, 0, 1, 1, 1, 2, 2]
    rows = fc.targets(polls, names, windows, 0.75, 0.25).collect()
    got = {(r["ventana"], r["candidato"]): r["objetivo"] for r in rows}
    assert got == pytest.approx({(w, c): mix[p][j] for w, p in enumerate(poll_of) for j, c in enumerate(names)})
    sums = fc.targets(polls, names, windows).groupBy("ventana").agg(F.sum("objetivo").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-12 for r in sums)


def test_all_zero_poll_keeps_zero(spark):
    df = spark.createDataFrame([(D(1), "A", 0.0), (D(1), "B", 0.0)], "fecha date, candidato string, v double")
    assert [r["s"] for r in df.select(fc.share_of(F.col("v"), ["fecha"]).alias("s")).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("block, fallback", [(1, False), (7, True), (400, False)])
def test_asof_equals_brute_force(spark, block, fallback):
    rng = random.Random(block)
    left = [(i, rng.choice("xyz"), D(rng.randrange(200))) for i in range(300)]
    right = [(rng.choice("xy"), D(rng.randrange(40, 200)), rng.random()) for _ in range(60)]
    right = list({(k, t): (k, t, v) for k, t, v in right}.values())
    ldf = spark.createDataFrame(left, "i int, k string, t date")
    rdf = spark.createDataFrame(right, "k string, u date, v double")
    got = {r["i"]: r["v"] for r in asof.asof_join(ldf, rdf, ["k"], "t", "u", ["v"], block, fallback).collect()}
    def want(k, t):
        own = sorted((u, v) for kk, u, v in right if kk == k)
        past = [v for u, v in own if u <= t]
        return past[-1] if past else (own[0][1] if fallback and own else None)
    assert got == {i: want(k, t) for i, k, t in left}


def test_asof_keeps_every_left_row(spark):
    left = spark.createDataFrame([(1, "a", D(1)), (2, "a", D(1)), (3, "a", None)], "i int, k string, t date")
    right = spark.createDataFrame([("a", D(0), 5.0)], "k string, u date, v double")
    rows = {r["i"]: r["v"] for r in asof.asof_join(left, right, ["k"], "t", "u", ["v"]).collect()}
    assert rows == {1: 5.0, 2: 5.0, 3: None}


def test_feature_table_rules(spark, polls):
    cols = "entidad string, red string, ventana int, fecha_ini_ventana date, fecha_fin_ventana date, score_final double"
    cand = spark.createDataFrame([("Ivan Cepeda", "twitter", 0, D(0), D(2), 0.5), ("Ivan Cepeda", "youtube", 0, D(0), D(2), 0.1),
                                  ("Ivan Cepeda", "twitter", 2, D(6), D(8), -0.2)], cols)
    party = spark.createDataFrame([("Pacto Historico", "tiktok", 1, D(3), D(5), 0.4)], cols)
    momentum = spark.createDataFrame([(0, 1.5)], "ventana int, M double")
    rows = {r["ventana"]: r.asDict() for r in ft.build_feature_table(cand, party, polls, momentum).collect()}
    assert set(rows) == {0, 1, 2}
    # the mean covers the networks present: one network in window 2
    assert rows[0]["SP1_Ivan"] == pytest.approx(0.3) and rows[2]["SP1_Ivan"] == -0.2 and rows[1]["SP1_Ivan"] == 0.0
    assert rows[1]["SX2_Pacto_Historico"] == 0.4 and rows[1]["SP2_Pacto_Historico"] == 0.4
    assert rows[0]["M"] == 1.5 and rows[1]["M"] == 0.0
    assert rows[0]["ENC_A"] == pytest.approx(0.3) and rows[2]["ENC_C"] == 0.0


def test_scaling_sequences_and_split(spark):
    df = spark.createDataFrame([(i, D(3 * i + 2), float(i), 7.0) for i in range(12)], "ventana int, fecha_fin_ventana date, x double, c double")
    scaled = fc.min_max_scaled(df, ["x", "c"])
    assert [r["x"] for r in scaled.orderBy("ventana").collect()] == pytest.approx([i / 11 for i in range(12)])
    assert {r["c"] for r in scaled.collect()} == {0.0}
    seqs = {r["ventana"]: r["historia"] for r in fc.sequences(df, ["x"]).collect()}
    assert set(seqs) == set(range(4, 12)) and seqs[5] == [[1.0], [2.0], [3.0], [4.0]]
    last = fc.last_sequence(df, ["x"]).first()
    assert last["historia"] == [[8.0], [9.0], [10.0], [11.0]] and (last["fecha_ini"], last["fecha_fin"]) == (D(36), D(38))
    parts = [r["parte"] for r in fc.time_split(df).orderBy("ventana").collect()]
    assert parts == ["train"] * 8 + ["validation"] + ["test"] * 3


def test_metrics_equal_numpy(spark):
    rng = np.random.default_rng(3)
    real, pred = rng.dirichlet([1, 2, 3], 20), rng.dirichlet([2, 2, 2], 20)
    real[0] = [0.005, 0.495, 0.5]
    rows = [(i, c, float(real[i, j]), float(pred[i, j])) for i in range(20) for j, c in enumerate("ABC")]
    df = spark.createDataFrame(rows, "ventana int, candidato string, real double, pred double")
    r, p = real.flatten(), pred.flatten()
    mask = r > 0.01
    got = fc.overall_metrics(df).first()
    assert got["r2"] == pytest.approx(1 - ((r - p) ** 2).sum() / ((r - r.mean()) ** 2).sum())
    assert got["mae"] == pytest.approx(np.abs(p - r).mean())
    assert got["mape"] == pytest.approx(np.abs((r[mask] - p[mask]) / r[mask]).mean() * 100)
    assert got["brier"] == pytest.approx(((pred - real) ** 2).sum(axis=1).mean())
    assert got["kl"] == pytest.approx((real * (np.log(real + 1e-8) - np.log(pred + 1e-8))).sum(axis=1).mean())
    flat = df.withColumn("real", F.lit(0.2))
    assert all(x["r2"] is None for x in fc.candidate_metrics(flat).collect())


def test_period_bounds_and_empty_entities(spark):
    at = lambda d, h=0: dt.datetime(2026, 3, d, h)
    rows = [("twitter", at(8), 0.5, 0, 0.0, ["A"]), ("twitter", at(12), 0.5, 1, 3.0, ["A", "B"]), ("twitter", at(12, 1), 1.0, 0, 0.0, ["A"]),
            ("twitter", at(9), 1.0, 0, 0.0, []), ("twitter", None, 1.0, 0, 0.0, ["A"])]
    df = spark.createDataFrame(rows, "red string, fecha timestamp, score double, intencion_explicita int, engagement double, candidatos array<string>")
    got = {(r["entidad"], r["ventana"]): (r["menciones"], r["score_final"]) for r in wn.period_scores(df, "candidatos", "2026-03-08", "2026-03-12").collect()}
    assert got == {("A", 0): (1, 0.5), ("A", 1): (1, 0.8), ("B", 1): (1, 0.8)}


def test_columns_of_names_with_one_beginning_stay_apart(spark):
    from agoralake.operators import feature_table as ft
    from pyspark.sql import functions as F
    names = ["Movimiento Alternativo Indigena", "Movimiento Alternativo Social", "Verde", "Ana Ruiz", "Ana  Ruiz"]
    rows = spark.createDataFrame([(1, "2026-01-01", "2026-01-05", "twitter", n, float(i)) for i, n in enumerate(names)],
                                 "ventana int, fecha_ini_ventana string, fecha_fin_ventana string, red string, entidad string, score_final double")
    wide, columns = ft.pivot_scores(rows, 2, ft.underscore_slug(F.col("entidad"), 20))
    row = wide.first().asDict()
    assert len(columns) == 5 and sorted(row[c] for c in columns) == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert row["ST2_Verde"] == 2.0 and row["ST2_Movimiento_Alternativo_Social"] == 1.0
