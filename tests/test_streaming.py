import os
import threading
import time

import pytest

from agoralake.plans.jobs import Lake
from agoralake.sources import files
from agoralake.streaming import inbox

HEAD = "id,Query,datetime,username,content,replies,retweets,likes\n"


def put(tmp_path, name, ids, text="hola a todos {i}"):
    target = tmp_path / "inbox" / name
    target.parent.mkdir(parents=True, exist_ok=True)
    staged = tmp_path / "staged.csv"
    staged.write_text(HEAD + "".join(f"{i},q,2026-05-19 10:00:00,u,{text.format(i=i)},1,1,1\n" for i in ids))
    os.replace(staged, target)


def run(lake, tmp_path, **kw):
    q = inbox.stream_posts(lake, f"file:{tmp_path}/inbox", "twitter", f"file:{tmp_path}/checkpoint", **kw)
    q.awaitTermination()
    return q


def test_restart_adds_nothing_and_later_files_are_taken(spark, tmp_path):
    lake = Lake(spark, f"file:{tmp_path}/lake")
    put(tmp_path, "twitter/2026-05-19/a.csv", range(5))
    put(tmp_path, "twitter/2026-05-19/run_videos.csv", range(90, 95))
    put(tmp_path, "twitter/mayo/x.csv", range(50, 55))
    run(lake, tmp_path)
    ids = lambda: sorted(r["id"] for r in lake.silver().latest().select("id").collect())
    assert ids() == [f"tw_{i}" for i in range(5)]
    run(lake, tmp_path)
    assert len(ids()) == 5
    # known ids keep their first text across batches
    put(tmp_path, "twitter/2026-05-20/b.csv", range(3, 8), "otro texto {i}")
    run(lake, tmp_path)
    assert ids() == [f"tw_{i}" for i in range(8)]
    rows = {r["id"]: r["text_clean"] for r in lake.silver().latest().collect()}
    assert rows["tw_3"] == "hola a todos 3" and rows["tw_7"] == "otro texto 7"
    assert lake.raw().latest().count() == 8 and lake.reports().latest().count() >= 2


def test_a_repeated_batch_overwrites_itself(spark, tmp_path):
    lake = Lake(spark, f"file:{tmp_path}/lake")
    handle = inbox.post_batch(lake, "twitter")
    rows = spark.createDataFrame([("1", "hola", "file:/in/a.csv"), ("1", "nuevo", "file:/in/a.csv")], "id string, content string, file_path string").coalesce(1)
    for _ in range(2):
        handle(rows, 0)
    got = lake.silver().latest().collect()
    assert len(got) == 1 and got[0]["text_clean"] == "nuevo" and len(lake.raw().versions()) == 1


def test_finished_files_are_archived(spark, tmp_path):
    lake = Lake(spark, f"file:{tmp_path}/lake")
    for day in ("2026-05-18", "2026-05-19", "2026-05-20"):
        put(tmp_path, f"twitter/{day}/a.csv", [day])
        run(lake, tmp_path, archive=f"file:{tmp_path}/done")
    assert lake.silver().latest().count() == 3
    archived = [f for _, _, names in os.walk(tmp_path / "done") for f in names]
    assert archived, "the file source archives files of committed batches"


def test_streams_of_one_lake_keep_their_own_rows(spark, tmp_path):
    lake = Lake(spark, f"file:{tmp_path}/lake")
    for name in ("a", "b"):
        put(tmp_path, f"{name}/twitter/2026-05-19/x.csv", [name])
        inbox.stream_posts(lake, f"file:{tmp_path}/inbox/{name}", "twitter", f"file:{tmp_path}/checkpoint-{name}").awaitTermination()
    assert sorted(r["id"] for r in lake.silver().latest().collect()) == ["tw_a", "tw_b"] == sorted(r["id"] for r in lake.raw().latest().collect())


def test_streamed_files_follow_their_headers_and_any_case(spark, tmp_path):
    lake = Lake(spark, f"file:{tmp_path}/lake")
    put(tmp_path, "twitter/2026-05-19/a.csv", [1])
    day = tmp_path / "inbox/twitter/2026-05-19"
    (day / "B.CSV").write_text("likes,content,id,datetime\n9,al reves,2,2026-05-19 11:00:00\n")
    (day / "c.csv.tmp").write_text("likes,content,id\n9,nada,3\n")
    (day / "Y_VIDEOS.CSV").write_text("video_id\n5\n")
    run(lake, tmp_path)
    assert {r["id"]: r["text_clean"] for r in lake.silver().latest().collect()} == {"tw_1": "hola a todos 1", "tw_2": "al reves"}
    runs = lake.ledger().runs().collect()
    # The rows are days old, so the gate's freshness check fails, and the ledger says so.
    assert [(r["flow_name"], r["status"], r["rows_out"]) for r in runs] == [("stream_silver", "quality_failed", 2)]
    assert lake.reports().latest().first()["overall"] == "FAIL"


def test_rejected_rows_of_a_stream_are_kept(spark, tmp_path):
    lake = Lake(spark, f"file:{tmp_path}/lake")
    day = tmp_path / "inbox/tiktok/2026-05-19"
    day.mkdir(parents=True)
    (day / "a.csv").write_text("text,comment_id\nbueno,1\nsin id,\n")
    inbox.stream_posts(lake, f"file:{tmp_path}/inbox", "tiktok", f"file:{tmp_path}/checkpoint").awaitTermination()
    bad = lake.quarantine().latest().collect()
    assert len(bad) == 1 and "sin id" in bad[0]["payload"] and bad[0]["error"] == "comment_id missing"
    assert lake.raw().latest().count() + len(bad) == 2


def test_streamed_external_files_with_unlike_names(spark, tmp_path):
    lake = Lake(spark, f"file:{tmp_path}/lake")
    day = tmp_path / "inbox/external/2026-05-19"
    day.mkdir(parents=True)
    (day / "a.csv").write_text("id,text,date\n1,hola a todos,2026-05-19 10:00:00\n")
    (day / "b.csv").write_text("mensaje,fecha,usuario\nbuenas tardes,2026-05-19 11:00:00,bea\nhasta luego,2026-05-19 12:00:00,eva\n")
    inbox.stream_posts(lake, f"file:{tmp_path}/inbox", "external", f"file:{tmp_path}/checkpoint").awaitTermination()
    got = {r["text_clean"]: r for r in lake.silver().latest().collect()}
    assert set(got) == {"hola a todos", "buenas tardes", "hasta luego"} and got["hola a todos"]["id"] == "ext_1"
    assert all(r["datetime_utc"] is not None for r in got.values())


def test_a_file_is_loaded_once_by_batch_and_stream(spark, tmp_path):
    from agoralake.plans import jobs
    lake = Lake(spark, f"file:{tmp_path}/lake")
    put(tmp_path, "twitter/2026-05-19/a.csv", range(5))
    jobs.run_batch(lake, f"file:{tmp_path}/inbox/twitter/2026-05-19/a.csv", "twitter", gate=False)
    put(tmp_path, "twitter/2026-05-19/b.csv", range(5, 8))
    put(tmp_path, "twitter/2026-05-20/copy.csv", range(5))
    run(lake, tmp_path)
    assert lake.raw().history().count() == lake.silver().latest().count() == 8
    again = jobs.run_batch(lake, f"file:{tmp_path}/inbox/twitter/2026-05-19/b.csv", "twitter", gate=False)
    assert again["rows_bronze"] == 0 and again["resumed"] == [] and lake.raw().history().count() == 8
    assert {r["stage"] for r in lake.files().state().collect()} == {"done"}


def test_repeats_are_dropped_with_bounded_state(spark, tmp_path):
    lake = Lake(spark, f"file:{tmp_path}/lake")
    schema = "id string, content string, datetime string, arrived timestamp"
    (tmp_path / "rows").mkdir()

    def add(name, ids, day):
        (tmp_path / "rows" / name).write_text("".join(
            f'{{"id": "{i}", "content": "texto {name} {i}", "datetime": "2026-05-19", "arrived": "2026-05-{day:02d}T10:00:00"}}\n' for i in ids))
        rows = spark.readStream.schema(schema).json(f"file:{tmp_path}/rows")
        q = inbox.stream_rows(lake, rows, "twitter", f"file:{tmp_path}/rows-checkpoint", ["id"], "arrived", "2 days")
        q.awaitTermination()
        return q.recentProgress

    add("a.json", [1, 2, 3, 3, 2], 1)
    add("b.json", [3, 4], 2)              # after a restart 3 is still known to the stream
    assert lake.raw().history().count() == 4
    add("c.json", range(10, 20), 9)       # a week later the first keys leave the state
    add("d.json", [1, 20], 9)             # 1 passes the stream and is dropped by the ids of silver
    last = add("e.json", [21], 9)
    held = [op["numRowsTotal"] for p in last for op in p["stateOperators"]]
    assert held and max(held) <= 13
    texts = {r["id"]: r["text_clean"] for r in lake.silver().latest().collect()}
    assert len(texts) == 16 and texts["tw_1"] == "texto a.json 1" and texts["tw_3"].startswith("texto a.json")


def grow(path, ids, pause):
    """A writer that appends rows to a file in place."""
    def write():
        for i in ids:
            time.sleep(pause)
            with open(path, "a") as f:
                f.write(f"{i},q,2026-05-19 10:00:00,u,hola a todos {i},1,1,1\n")
    writer = threading.Thread(target=write)
    writer.start()
    return writer


def test_a_stream_waits_for_a_growing_file(spark, tmp_path):
    lake = Lake(spark, f"file:{tmp_path}/lake")
    put(tmp_path, "twitter/2026-05-19/a.csv", range(2))
    writer = grow(tmp_path / "inbox/twitter/2026-05-19/a.csv", range(2, 14), 0.5)
    run(lake, tmp_path, quiet=2)
    assert not writer.is_alive()
    writer.join()
    ids = lambda: sorted(int(r["id"][3:]) for r in lake.silver().latest().select("id").collect())
    assert ids() == list(range(14))
    run(lake, tmp_path, quiet=1)
    assert ids() == list(range(14))


def test_waiting_for_files(spark, tmp_path):
    put(tmp_path, "twitter/2026-05-19/a.csv", range(2))
    path = tmp_path / "inbox/twitter/2026-05-19/a.csv"
    files.wait_until_settled(spark, [], 5)
    files.wait_until_settled(spark, ["file:/no/such/file.csv"], 0)
    files.wait_until_settled(spark, [f"file:{path}"], 0.2)
    writer = grow(path, range(2, 30), 0.2)
    with pytest.raises(TimeoutError, match="a.csv"):
        files.wait_until_settled(spark, [f"file:{path}"], 1, at_most=0)
    writer.join()
