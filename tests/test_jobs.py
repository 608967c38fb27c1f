import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from agoralake.operators.dedupe import dedupe, dedupe_few
from agoralake.plans import jobs, layers, scorers, views
from agoralake.plans.jobs import Lake
from agoralake.session import FREED, stored
from agoralake.sources import files, tables

NOW = dt.datetime(2026, 5, 20)


def as_of():
    return F.lit("2026-05-20 00:00:00").cast("timestamp")


def tweets(path, n=12, day="2026-05-19", start=0, text="el pacto historico va a ganar hoy {i}", extra=""):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = ["id,Query,datetime,username,content,replies,retweets,likes"]
    lines += [f"{i},paz,{day} 10:00:00,user{i},{text.format(i=i)},1,2,{i}" for i in range(start, start + n)]
    path.write_text("\n".join(lines) + "\n" + extra)
    return str(path)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"file:{tmp_path}/lake")


def statuses(lake):
    return {r["run_id"]: r for r in lake.ledger().runs().collect()}


def test_pass_reaches_gold(lake, tmp_path):
    extra = "0,paz,2026-05-19 11:00:00,user0,ultima version del post cero ya,1,2,99\n"
    out = jobs.run_batch(lake, tweets(tmp_path / "a.csv", extra=extra), "twitter", skip_gold=False, as_of=as_of())
    assert (out["status"], out["rows_bronze"], out["rows_silver"], out["rows_gold"], out["quality_overall"]) == (
        "success", 12, 12, 12, "PASS")
    row = statuses(lake)[out["run_id"]]
    assert row["flow_name"] == "e2e" and row["rows_out"] == 12 and row["quality_summary"]["overall"] == "PASS"
    assert row["started_at"] is not None and row["finished_at"] is not None
    # the last of two equal ids in a file wins in raw
    gold = {r["id"]: r for r in lake.gold().latest().collect()}
    assert gold["tw_0"]["engagement"]["likes"] == 99 and gold["tw_0"]["days_until_election"] == 11
    daily = tables.read_daily(lake.spark, f"{lake.root}/public/v_sentiment_daily").collect()
    assert [(r["source"], r["posts"]) for r in daily] == [("twitter", 12)]
    report = lake.reports().latest().collect()
    assert len(report) == 1 and report[0]["overall"] == "PASS" and len(report[0]["checks"]) == 5
    raw, silver = lake.raw().history(), lake.silver().history()
    counts = views.layer_counts(raw, silver, lake.gold().latest(), out["run_id"]).collect()
    assert {tuple(r) for r in counts} == {("raw", 12), ("silver", 12), ("gold", 12)}


def test_default_stops_after_the_gate(lake, tmp_path):
    out = jobs.run_batch(lake, tweets(tmp_path / "a.csv"), "twitter", as_of=as_of())
    assert out["status"] == "success" and out["rows_gold"] == 0 and out["quality_overall"] == "PASS"
    assert statuses(lake)[out["run_id"]]["flow_name"] == "e2e_silver_only" and lake.gold().versions() == []


def test_fail_blocks_gold(lake, tmp_path):
    out = jobs.run_batch(lake, tweets(tmp_path / "a.csv", day="2026-06-01"), "twitter", skip_gold=False, as_of=as_of())
    assert out["status"] == "quality_failed" and out["quality_overall"] == "FAIL" and out["rows_gold"] == 0
    assert statuses(lake)[out["run_id"]]["status"] == "quality_failed" and lake.gold().versions() == []


def test_warn_goes_on(lake, tmp_path):
    old = "".join(f"{100 + i},paz,2026-01-01 10:00:00,u,mensaje antiguo numero {i},1,1,1\n" for i in range(5))
    out = jobs.run_batch(lake, tweets(tmp_path / "a.csv", extra=old), "twitter", skip_gold=False, as_of=as_of())
    assert out["quality_overall"] == "WARN" and out["status"] == "success" and out["rows_gold"] == 17


def test_same_bytes_are_skipped_and_known_ids_stay(lake, tmp_path):
    path = tweets(tmp_path / "a.csv")
    jobs.run_batch(lake, path, "twitter", as_of=as_of())
    again = jobs.run_batch(lake, tweets(tmp_path / "copy.csv"), "twitter", as_of=as_of())
    assert (again["status"], again["rows_bronze"]) == ("success", 0)
    known = jobs.run_batch(lake, tweets(tmp_path / "b.csv", text="otro texto {i}"), "twitter", as_of=as_of())
    assert (known["status"], known["rows_bronze"], known["rows_silver"], known["quality_overall"]) == ("success", 12, 0, None)
    assert lake.silver().latest().count() == 12
    more = jobs.run_batch(lake, tweets(tmp_path / "c.csv", start=6), "twitter", as_of=as_of())
    assert more["rows_silver"] == 6


def test_a_repeated_run_changes_nothing(lake, tmp_path):
    path = tweets(tmp_path / "a.csv")
    seq = 5
    run_id = lake.ledger().start("e2e")
    for _ in range(2):
        jobs.load_bronze(lake, path, "twitter", run_id, seq)
        assert jobs.promote_silver(lake, run_id, seq) == 12
        assert jobs.promote_gold(lake, run_id, seq) == 12
    assert lake.silver().latest().count() == 12 and lake.gold().latest().count() == 12


def test_empty_and_unknown_input(lake, tmp_path):
    empty = tmp_path / "e.csv"
    empty.write_text("")
    assert jobs.run_batch(lake, str(empty), "twitter")["rows_bronze"] == 0
    assert jobs.run_batch(lake, str(empty), "myspace")["status"] == "success"


def test_failure_is_recorded(lake, tmp_path, monkeypatch):
    def broken(*a, **k):
        raise RuntimeError("silver is down")
    monkeypatch.setattr(jobs, "promote_silver", broken)
    with pytest.raises(RuntimeError, match="silver is down"):
        jobs.run_batch(lake, tweets(tmp_path / "a.csv"), "twitter", as_of=as_of())
    row = list(statuses(lake).values())[0]
    assert row["status"] == "failed" and "silver is down" in row["error"]


def test_second_context_and_analysis(lake, tmp_path):
    jobs.run_batch(lake, tweets(tmp_path / "a.csv"), "twitter", skip_gold=False, as_of=as_of())
    out = jobs.run_batch(lake, tweets(tmp_path / "p.csv", start=6, text="paloma valencia candidata del pueblo {i}"), "twitter",
                         context="posts_parlamentarias", gate=False, skip_gold=False)
    assert out["rows_silver"] == 12 and out["rows_gold"] == 0
    both = jobs.load_contexts(lake)
    assert both.count() == 18
    scorer = scorers.LexiconScorer(["ganar"], ["candidata"])
    got = jobs.run_analysis(lake, scorer, period=("2026-05-01", "2026-06-01"))
    scores = {r["entidad"]: r for r in got["scores_candidato_red"].collect()}
    assert scores["Ivan Cepeda"]["menciones"] == 12 and scores["Paloma Valencia"]["menciones"] == 6
    assert scores["Ivan Cepeda"]["score_promedio"] == 1.0 and scores["Paloma Valencia"]["score_promedio"] < 0
    exploded = got["scored"].agg(F.sum(F.size("candidatos"))).first()[0]
    assert exploded == sum(r["menciones"] for r in scores.values())
    features = got["features"].first().asDict()
    assert features["ST1_Ivan"] == 1.0 and features["SP2_Pacto_Historico"] == 1.0
    assert [r["posicion"] for r in got["ranking"].orderBy("score_promedio", ascending=False).collect()] == [1, 2]
    assert got["parlamentarias_partido_red"].count() == 2
    assert jobs.load_contexts(lake, F.lit("2026-05-20").cast("timestamp")).count() == 0


def test_videos_are_refreshed(lake, tmp_path):
    head = "video_id,title,view_count,published_at\n"
    (tmp_path / "v1.csv").write_text(head + "a,T,10,2026-01-01T00:00:00Z\n,x,1,\nb,U,nan,\n")
    (tmp_path / "v2.csv").write_text(head + "a,T,25.0,2026-01-01T00:00:00Z\n")
    assert jobs.run_videos(lake, str(tmp_path / "v1.csv"), "youtube")["rows"] == 2
    assert jobs.run_videos(lake, str(tmp_path / "v2.csv"), "youtube")["rows"] == 1
    rows = {r["video_id"]: r["view_count"] for r in lake.videos("youtube").latest().collect()}
    assert rows == {"a": 25, "b": None}
    assert jobs.run_videos(lake, str(tmp_path / "v1.csv"), "twitter")["status"] == "skipped"


def test_whole_inbox(lake, tmp_path):
    inbox = tmp_path / "inbox"
    tweets(inbox / "twitter/2026-05-19/a.csv")
    tweets(inbox / "twitter/2026-05-20/b.csv", start=6)
    tweets(inbox / "twitter/mayo/c.csv", start=50)
    tweets(inbox / "myspace/2026-05-20/d.csv", start=70)
    (inbox / "youtube/2026-05-20").mkdir(parents=True)
    (inbox / "youtube/2026-05-20/run_1_videos.csv").write_text("video_id,title\nv,T\n")
    got = jobs.run_inbox(lake, f"file:{inbox}", as_of=as_of())
    assert [(r["source"], r["videos"], r["status"]) for r in got] == [("twitter", False, "success"), ("youtube", True, "success")]
    assert lake.silver().latest().count() == 18 and lake.videos("youtube").latest().count() == 1


def test_media_job(lake, tmp_path):
    (tmp_path / "m.csv").write_text("article_id,medio,fecha,candidato,menciones\na,M,2026-01-02,C,3\na,M,2026-01-02,C,4\nb,M,2026-01-02,C,\n")
    (tmp_path / "s.csv").write_text("fecha,medio,candidato,menciones,share_of_voice\n2026-01-01,m,A,1,0.1\n")
    (tmp_path / "q.csv").write_text("fecha,medio,candidato,menciones,share_of_voice,rolling_7,momentum\n2026-01-01,m,B,5,0.5,1,1\n")
    rows = {tuple(r) for r in jobs.run_media(lake, str(tmp_path / "m.csv"), str(tmp_path / "s.csv"), str(tmp_path / "q.csv")).collect()}
    assert rows == {("mentions", 2), ("share_of_voice", 2), ("momentum", 1)}
    assert {r["article_id"]: r["menciones"] for r in lake.media("mentions").latest().collect()} == {"a": 4, "b": 1}
    assert jobs.run_media(lake).count() == 0


def test_silver_rules(spark):
    from agoralake import schemas
    rows = [("tw_1", "twitter", "1", "2026-01-01", "ana", "Llama al 3001234567 ya", None, {"likes": 1},
             {"username": "ana", "query": "q"}, i) for i in (2, 1)]
    rows.append(("tw_2", "twitter", None, None, "", "hola #a", None, {}, {}, 3))
    schema = schemas.T.StructType([*schemas.BRONZE_POST.fields[:-1], schemas.T.StructField("seq", schemas.L)])
    posts = spark.createDataFrame(rows, schema)
    good, bad = layers.to_silver(posts, None, "r", F.current_timestamp())
    row = good.collect()
    assert len(row) == 1 and row[0]["text_clean"] == "llama al 3001234567 ya" and row[0]["text_original"] == "Llama al [PHONE] ya"
    assert row[0]["author_id"] == "ana" and row[0]["metadata"] == {"query": "q"} and row[0]["pii_types"] == ["phone"]
    assert [(r["id"], r["error"]) for r in bad.collect()] == [("tw_2", "source_id_missing")]
    masked, _ = layers.to_silver(posts, None, "r", F.current_timestamp(), mask_first=True)
    assert masked.first()["text_clean"] == "llama al [phone] ya" and masked.first()["pii_detected"]
    flags = layers.to_gold(good.withColumn("has_hashtags", F.lit(True)), "r", F.current_timestamp())
    assert flags.first()["has_hashtags"]
    assert not layers.to_gold(good.withColumn("has_hashtags", F.lit(True)), "r", F.current_timestamp(), parity_flags=True).first()["has_hashtags"]


def test_language_fallback(spark):
    df = spark.createDataFrame([("hola amigo", "unknown"), ("x", None), ("el de", "es"), ("falla", "unknown")], "t string, lang string")
    def detector(value):
        if value == "falla":
            raise ValueError
        return "pt"
    got = [r["lang"] for r in layers.with_language_fallback(df, "t", detector=detector).collect()]
    assert got == ["pt", None, "es", "unknown"]
    assert [r["lang"] for r in layers.with_language_fallback(df, "t").collect()] == ["unknown", None, "es", "unknown"]


def test_model_scorer_survives_a_bad_batch(spark):
    class Picky(scorers.BatchModel):
        def predict(self, texts):
            if any("malo" in t for t in texts):
                raise ValueError
            return [("POS", 0.9)] * len(texts)
    df = spark.createDataFrame([(t, NOW) for t in ("uno", "malo", "tres")], "texto_usuario_norm string, fecha timestamp").coalesce(1)
    got = scorers.with_sentiment(df, scorers.ModelScorer(Picky(), batch=1)).collect()
    assert [(r["score"], r["sentimiento"]) for r in got] == [(0.9, "positivo"), (0.0, "neutro"), (0.9, "positivo")]
    whole = scorers.with_sentiment(df, scorers.ModelScorer(Picky())).collect()  # one batch: only the text at fault is lost
    assert [(r["score"], r["score_error"]) for r in whole] == [(0.9, None), (0.0, "ValueError: "), (0.9, None)]
    assert scorers.ModelScorer(Picky()).info() == {"model_name": "unknown", "version": "0.0"}


def test_a_second_analysis_scores_only_new_posts(spark, lake, tmp_path):
    def load(name, start, day):
        path = tmp_path / name
        path.write_text("id,content,datetime,username,likes\n" + "".join(
            f"{start + i},texto {start + i} de cepeda bien,{day} 10:0{i}:00,u,1\n" for i in range(4)))
        jobs.run_batch(lake, str(path), "twitter")

    scorer = scorers.LexiconScorer(["bien"], ["mal"])
    load("one.csv", 0, "2026-05-18")
    first = jobs.run_analysis(lake, scorer, resume=True)
    assert first["scored"].count() == 4 and first["features"].count() == 1
    load("two.csv", 10, "2026-05-19")
    again = jobs.run_analysis(lake, scorer, resume=True)
    newly = (tmp_path / "lake" / "analysis").glob("*/new_scored")
    counts = sorted(spark.read.parquet(str(p)).count() for p in newly)
    assert again["scored"].count() == 8 and counts == [4, 5]  # the post at the mark is scored once more
    assert again["scores_candidato_red"].agg(F.sum("menciones")).first()[0] == 8


def scan_rows(df):
    """Rows that the first file scan of a query gave."""
    df.collect()
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop(0)
        if "Scan parquet" in node.nodeName():
            return node.metrics().apply("numOutputRows").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    raise AssertionError("no scan")


def test_a_small_batch_reads_the_pages_of_its_ids(spark, lake):
    ids = lake.ids()
    many = spark.range(1_000_000).select(F.concat(F.lit("tw_"), "id").alias("id"))
    ids.add(many, "one", 1)
    posts = spark.range(999_850, 1_000_150).select(F.concat(F.lit("tw_"), "id").alias("id"))
    held = ids.table.without_run("two").where(F.col("h").isin([r["h"] for r in posts.select(F.xxhash64("id").alias("h")).collect()]))
    ids.known(posts.limit(0), "two")
    assert ids.known(posts, "two").count() == 150 and ids.known(many, "two").count() == 1_000_000
    assert ids.known(posts, "one").count() == 0
    assert scan_rows(held.select("id")) < 150_000  # of 10^6
    ids.add(many.limit(500), "two", 2)
    ids.table.compact(3)
    assert ids.known(posts, "two").count() == 150


def test_a_lake_from_before_the_id_index_gets_one(spark, lake, tmp_path):
    jobs.run_batch(lake, tweets(tmp_path / "a.csv"), "twitter")
    fs, path = files.hadoop_path(spark, lake.ids().table.path)
    fs.delete(path, True)
    assert jobs.known_ids(lake, spark.createDataFrame([("tw_1",), ("x",)], "id string"), "other", 1).collect() == [("tw_1",)]


# A function that fails, or a table after whose write the run breaks off, each at the end of its stage.
STEPS = ["store_bronze", "raw", "promote_silver", "ids", "reports", "gold", "refresh_views", "ledger"]


@pytest.mark.parametrize("step,as_inbox", [*[(s, False) for s in STEPS], ("promote_silver", True)])
def test_a_broken_run_is_finished_by_the_next(lake, tmp_path, monkeypatch, step, as_inbox):
    path = tmp_path / "inbox/twitter/2026-05-19/a.csv"
    tweets(path)
    go = (lambda: jobs.run_inbox(lake, f"file:{tmp_path}/inbox", skip_gold=False, as_of=as_of())) if as_inbox else (
        lambda: jobs.run_batch(lake, str(path), "twitter", skip_gold=False, as_of=as_of()))
    broken = {"left": 1}

    def once(real, when=lambda *a: True):
        def call(*a, **k):
            if broken["left"] and when(*a):
                broken["left"] -= 1
                raise RuntimeError(f"{step} is down")
            return real(*a, **k)
        return call

    if hasattr(jobs, step):
        monkeypatch.setattr(jobs, step, once(getattr(jobs, step)))
    elif step == "ledger":
        monkeypatch.setattr(jobs.Ledger, "finish", once(jobs.Ledger.finish))
    else:  # the write itself is done, the step after it is not
        folder = {"raw": "raw/posts", "ids": "ops/silver_ids_posts", "reports": "ops/quality_reports", "gold": "gold/features"}[step]
        real = tables.VersionedTable.write

        def write(table, *a, **k):
            real(table, *a, **k)
            if broken["left"] and table.path.endswith(folder):
                broken["left"] -= 1
                raise RuntimeError(f"{step} is down")
        monkeypatch.setattr(tables.VersionedTable, "write", write)
    if as_inbox:
        assert go()[0]["status"] == "failed"
    else:
        with pytest.raises(RuntimeError, match="is down"):
            go()
    first = set(statuses(lake))
    again = go()
    if step == "store_bronze":  # nothing was stored: the files are new to the second run
        assert again["rows_gold"] == 12
    else:
        again = again[0] if as_inbox else again
        assert [r["run_id"] for r in again["resumed"]] == list(first) and again["rows_bronze"] == 0
        assert statuses(lake)[list(first)[0]]["status"] == "success"
    assert lake.raw().latest().count() == lake.silver().latest().count() == lake.gold().latest().count() == 12
    daily = tables.read_daily(lake.spark, f"{lake.root}/public/v_sentiment_daily").collect()
    assert [(r["source"], r["posts"]) for r in daily] == [("twitter", 12)]
    assert lake.files().state().where("stage <> 'done'").count() == 0 and lake.ids().table.latest().count() == 12
    if step == "ledger":
        third = go()
        assert third["resumed"] == [] and third["rows_bronze"] == 0 and lake.gold().latest().count() == 12


def test_runs_can_be_finished_without_their_files(lake, tmp_path, monkeypatch):
    path = tmp_path / "a.csv"
    with monkeypatch.context() as m:
        m.setattr(jobs, "run_gate", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.run_batch(lake, tweets(path), "twitter", skip_gold=False, as_of=as_of())
    path.unlink()
    done = jobs.resume_runs(lake, as_of=as_of())
    assert [(r["status"], r["rows_silver"], r["rows_gold"]) for r in done] == [("success", 12, 12)] and jobs.resume_runs(lake) == []


def test_scores_reach_gold_and_the_daily_view(spark, lake, tmp_path):
    jobs.run_batch(lake, tweets(tmp_path / "a.csv", text="el pacto historico va bien hoy {i}"), "twitter", skip_gold=False, as_of=as_of())
    jobs.run_batch(lake, tweets(tmp_path / "b.csv", day="2026-05-18", start=20, text="el pacto historico va mal hoy {i}"), "twitter", skip_gold=False, as_of=as_of())
    scorer = scorers.LexiconScorer(["bien"], ["mal"])
    for _ in range(2):
        jobs.run_analysis(lake, scorer, resume=True)
        gold = lake.gold().latest()
        assert {(r["event_day"], r["sentiment_label"], r["sentiment_score"]) for r in gold.collect()} == {
            ("2026-05-19", "positive", 1.0), ("2026-05-18", "negative", -1.0)}
        daily = {str(r["day"]): tuple(r)[2:] for r in tables.read_daily(spark, f"{lake.root}/public/v_sentiment_daily").collect()}
        assert daily == {"2026-05-19": (12, 12, 0, 0, 1.0), "2026-05-18": (12, 0, 12, 0, -1.0)}
    want = sorted(map(tuple, views.sentiment_daily(lake.gold().latest()).collect()))
    assert sorted((r[0], r[1], *r[2:]) for r in daily_rows(lake)) == want


def daily_rows(lake):
    return [tuple(r) for r in tables.read_daily(lake.spark, f"{lake.root}/public/v_sentiment_daily").collect()]


def test_the_second_analysis_prunes_days_and_finds_late_posts(spark, lake, tmp_path):
    for i, day in enumerate(["2026-04-10", "2026-05-17", "2026-05-18"]):
        jobs.run_batch(lake, tweets(tmp_path / f"{i}.csv", day=day, start=20 * i, text="el pacto historico va bien hoy {i}"), "twitter")
    scorer = scorers.LexiconScorer(["bien"], ["mal"])
    assert jobs.run_analysis(lake, scorer, resume=True)["scored"].count() == 36
    since = F.lit("2026-05-18 00:00:00").cast("timestamp")
    plan = jobs.load_contexts(lake, since)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*event_day#\d+ >= 2026-05-18", plan), plan
    late = jobs.load_contexts(lake, since, F.lit("2026-05-20 00:00:00").cast("timestamp"))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*event_day#\d+ >= 2026-05-18\) OR \(cleaned_month#\d+ >= 2026-05", late), late
    jobs.run_batch(lake, tweets(tmp_path / "late.csv", day="2026-04-11", start=100, text="el pacto historico va mal hoy {i}"), "twitter")
    again = jobs.run_analysis(lake, scorer, resume=True)
    assert again["scored"].count() == 48  # the late posts are older than the mark and still there
    newly = sorted(spark.read.parquet(str(p)).count() for p in (tmp_path / "lake" / "analysis").glob("*/new_scored"))
    assert newly == [24, 36]  # 12 late ones and the 12 at the mark


def test_tables_are_folded_by_rule(spark, lake, tmp_path):
    table = lake._table("t", files.schemas.T.StructType([files.schemas.T.StructField("id", files.schemas.S)]), ["id"])
    one = spark.createDataFrame([("a",)], "id string")
    for i in range(16):
        assert not table.compact_when_due(i)
        table.write(one, i, f"r{i}")
    assert table.compact_when_due(99) and len(table.versions()) == 1 and table.runs() == [f"r{i}" for i in range(16)]
    broken = tmp_path / "lake/t/version=00000000000000000098-x~1"
    broken.mkdir()
    table.vacuum()
    assert not broken.exists() and table.latest().count() == 1


def test_texts_a_model_fails_on_are_counted_and_kept_apart(lake, tmp_path):
    class Picky(scorers.BatchModel):
        def predict(self, texts):
            if any("seven" in t for t in texts):
                raise ValueError("seven")
            return [("POS", 0.5)] * len(texts)
    extra = "70,paz,2026-05-19 11:00:00,u,el pacto historico va por el seven hoy,1,1,1\n"
    jobs.run_batch(lake, tweets(tmp_path / "a.csv", extra=extra), "twitter")
    got = jobs.run_analysis(lake, scorers.ModelScorer(Picky()))
    assert got["scored"].count() == 12 and got["ranking"].first()["menciones_total"] == 12
    kept = lake.quarantine().latest().where("source = 'analysis'").collect()
    assert len(kept) == 1 and kept[0]["error"] == "ValueError: seven" and "tw_70" in kept[0]["payload"]
    run = [r for r in statuses(lake).values() if r["flow_name"] == "analysis"][0]
    assert (run["rows_in"], run["rows_out"], run["quality_summary"]) == (13, 12, {"texts_failed": "1"})


def test_landing_and_alerts_are_stored(lake, tmp_path):
    out = jobs.run_landing(lake, tweets(tmp_path / "a.csv"), "twitter")
    assert out["rows"] == 12 and lake.landing().latest().count() == 12
    jobs.run_batch(lake, tweets(tmp_path / "b.csv", day="2026-06-01"), "twitter", as_of=as_of())
    assert [(r["severity"], r["delivered"]) for r in lake.alerts().latest().collect()] == [("CRITICAL", False)]


def test_texts_are_stored_few_times(spark, lake, tmp_path):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 9)) for _ in range(60))
    texts = [text() for _ in range(400)]
    (tmp_path / "in.csv").write_text("id,content,datetime,username,likes\n" + "".join(
        f"{i},{x},2026-05-{1 + i % 9:02d} 10:00:00,u,1\n" for i, x in enumerate(texts)))
    before = spark.conf.get(FREED)
    jobs.run_batch(lake, str(tmp_path / "in.csv"), "twitter", skip_gold=False, as_of=F.lit("2026-05-10").cast("timestamp"))
    out = jobs.run_analysis(lake, scorers.NeutralScorer())
    assert spark.conf.get(FREED) == before
    size = lambda folder: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    root, own = tmp_path / "lake", sum(map(len, texts))
    assert size(root / "analysis") < 2 * own  # four forms of each text
    assert size(root) < 5 * own  # and one in raw, two in silver
    rows = {r["id"]: r for r in out["scored"].collect()}
    assert len(rows) == 400
    for c in ("texto_usuario", "texto", "texto_usuario_norm", "texto_norm"):
        assert [rows[f"tw_{i}"][c] for i in range(400)] == texts
    assert out["scored"].columns[:6] == ["id", "texto", "texto_usuario", "texto_norm", "texto_usuario_norm", "red"]
    assert out["ultima_fecha"] is not None and lake.gold().latest().where("sentiment_label = 'neutral'").count() == 400


def test_posts_are_cleaned_once_and_after_they_are_dealt_out(spark):
    posts = spark.createDataFrame([("a", "twitter", "1", "2026-05-01", "u", "hola a todos", None, {}, {}, 1)], (
        "id string, source string, source_id string, datetime_utc string, username string, text string, parent_id string, "
        "engagement map<string,bigint>, metadata map<string,string>, seq long"))
    good, _ = layers.to_silver(posts, None, "r", F.current_timestamp(), arrange=jobs.posts_by_day)
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan and "text_clean" not in plan[plan.index("RebalancePartitions"):]
    assert [r["text_clean"] for r in good.collect()] == ["hola a todos"]


@pytest.mark.parametrize("keep", ["first", "last"])
def test_few_repeated_keys_are_found_without_the_rows(spark, tmp_path, keep):
    rows = [(k, n, f"{k}{n}") for n, k in enumerate(["a", "b", "a", None, "c", None, "b", "b"])]
    df = spark.createDataFrame(rows, "k string, n int, x string")
    got = dedupe_few(df, ["k"], ["n"], keep, store=lambda d: stored(d, "repeated"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, dedupe(df, ["k"], ["n"], keep).collect()), key=str)
    assert got.count() == 4
