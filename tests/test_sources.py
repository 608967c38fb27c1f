import hashlib

import pytest
from pyspark.sql import functions as F

from agoralake import schemas
from agoralake.sources import files, mappers, media, tables


def write(path, content, mode="w", **kw):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, mode, newline="" if "b" not in mode else None, **kw) as f:
        f.write(content)
    return str(path)


def posts(spark, path, source, reader=files.read_csv):
    good, bad = mappers.map_posts(reader(spark, path), source)
    return {r["id"]: r for r in good.collect()}, bad.collect()


def test_twitter_file(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'id,query,datetime,username,content,replies,retweets,likes\n'
                 '123.0,paz,2026-05-08,ana,"  hola, ""tú""\nlínea dos ",,2,12.7\n,,,,,,,\n')
    got, bad = posts(spark, path, "twitter")
    row = got["tw_123"]
    assert row["text"] == 'hola, "tú"\nlínea dos' and row["engagement"] == {"retweets": 2, "likes": 12}
    assert row["metadata"] == {"query": "paz"} and row["source_id"] == "123" and not bad
    assert got["tw_"]["datetime_utc"] is None and got["tw_"]["engagement"] == {}


def test_youtube_and_tiktok_files(spark, tmp_path):
    path = write(tmp_path / "y.csv", "id,parent_id,date,text,username,likes,views,video_id,video_title,query,source_type\n"
                 "yt_a,,2026,x,u,1,,v,,q,c\nb,yt_a,2026,y,u,,3,v,t,,r\n")
    got, _ = posts(spark, path, "youtube")
    assert set(got) == {"yt_a", "yt_b"} and got["yt_b"]["parent_id"] == "yt_a" and got["yt_a"]["source_id"] == "a"
    assert got["yt_b"]["metadata"] == {"video_id": "v", "video_title": "t"}
    path = write(tmp_path / "k.csv", "video_id,comment_id,create_time,user_unique_id,user_nickname,text,digg_count,reply_count\n"
                 "v,,2026,u,n,sin id,1,1\nv,tk_1,2026,,nick,x,2,\n")
    got, bad = posts(spark, path, "tiktok")
    assert got["tk_1"]["username"] == "nick" and got["tk_1"]["source_id"] == "tk_1" and len(bad) == 1
    assert bad[0]["error"] == "comment_id missing"


def test_facebook_ids_collapse_and_external_fallbacks(spark, tmp_path):
    path = write(tmp_path / "f.csv", "comentario,fecha,likes\nhola,2026-01-01,1\nhola,2026-01-01,2\nhola,2026-01-02,3\n")
    good, _ = mappers.map_posts(files.read_csv(spark, path), "facebook")
    assert good.count() == 3 and good.select("id").distinct().count() == 2
    path = write(tmp_path / "e.csv", "body,fecha,usuario\nuno,,x\nNA,2026-01-01,\n")
    first = {r["text"]: r for r in mappers.map_posts(files.read_csv(spark, path), "external")[0].collect()}
    again = {r["text"]: r for r in mappers.map_posts(files.read_csv(spark, path), "external")[0].collect()}
    assert set(first) == {"uno", "NA"} and first["uno"]["datetime_utc"] is None and first["NA"]["username"] is None
    assert {t: r["id"] for t, r in first.items()} == {t: r["id"] for t, r in again.items()}


def test_unknown_source_has_no_posts(spark, tmp_path):
    path = write(tmp_path / "e.csv", "id,text\n1,a\n")
    good, bad = mappers.map_posts(files.read_csv(spark, path), "myspace")
    assert good.count() == 0 and bad.count() == 0


@pytest.mark.parametrize("content", ["", "id,content\n", "\n\n"])
def test_bad_files_give_no_rows(spark, tmp_path, content):
    path = write(tmp_path / "b.csv", content)
    good, _ = mappers.map_posts(files.read_csv(spark, path), "twitter")
    assert good.count() == 0


def test_ragged_rows_are_kept(spark, tmp_path):
    path = write(tmp_path / "r.csv", "id,content,likes\n1,a\n2,b,3,4,5\n")
    got, _ = posts(spark, path, "twitter")
    assert got["tw_1"]["engagement"] == {} and got["tw_2"]["engagement"] == {"likes": 3}


def test_nested_file(spark, tmp_path):
    lines = [
        '﻿"postTitle,postDescription,text,likesCount,facebookUrl",',
        '"""T1"",""D, uno"",""lo prÃ³ximo, ya"",7,http://f/1",',
        '"""T2"",,https://f/2,1,http://f/2",',
        '"T3,d,corto",', '",,,,",', "",
    ]
    path = write(tmp_path / "n.csv", "\n".join(lines), encoding="utf-8")
    rows = {r["postTitle"]: r for r in files.read_nested_csv(spark, path).collect()}
    assert set(rows) == {"T1", "T2", "T3"} and rows["T1"]["text"] == "lo próximo, ya" and rows["T3"]["facebookUrl"] == ""
    got, bad = posts(spark, path, "fb_parlamentarias", files.read_nested_csv)
    assert len(got) == 2 and len(bad) == 1
    assert {r["text"] for r in got.values()} == {"lo próximo, ya", "corto"}


def test_required_columns_and_bom(spark, tmp_path):
    path = write(tmp_path / "m.csv", "﻿article_id,medio,fecha,candidato,menciones,titulo_flag\n"
                 "a1, M ,2026-01-02T00:00, C ,,1\n,M,2026-01-02,C,2,0\n", encoding="utf-8")
    rows = media.mentions(files.read_required(spark, path, ["article_id", "medio", "fecha", "candidato"])).collect()
    assert [(r["article_id"], r["medio"], r["candidato"], r["menciones"], r["titulo_flag"]) for r in rows] == [
        ("a1", "M", "C", 1, True)]
    with pytest.raises(ValueError, match="nope"):
        files.read_required(spark, path, ["nope"])


def test_optional_file(spark, tmp_path):
    df = files.read_csv_if_present(spark, str(tmp_path / "none.csv"), ["fecha", "encuestadora", "candidato", "intencion_voto"])
    assert files.polls(df).count() == 0


def test_polls_and_momentum_files(spark, tmp_path):
    path = write(tmp_path / "p.csv", "fecha,encuestadora,candidato,intencion_voto\n2026-01-15,I,A,0.18\n2026-01-15,I,B,s/d\n")
    assert [r["intencion_voto"] for r in files.polls(files.read_csv(spark, path)).orderBy("candidato").collect()] == [0.18, 0.0]
    path = write(tmp_path / "w.csv", "ventana,A,B\n0,0.5,\n2,x,1\n")
    rows = [tuple(r) for r in files.window_momentum(files.read_csv(spark, path)).orderBy("ventana").collect()]
    assert rows == [(0, 0.5, None), (2, None, 1.0)]


def test_share_of_voice_duplicates(spark, tmp_path):
    sov = write(tmp_path / "s.csv", "fecha,medio,candidato,menciones,share_of_voice\n2026-01-01,m,A,1,0.1\n2026-01-01,m,A,2,0.2\n")
    mom = write(tmp_path / "q.csv", "fecha,medio,candidato,menciones,share_of_voice,rolling_7,momentum\n"
                "2026-01-01,m,A,9,0.9,1.5,0.5\n2026-01-01,m,B,5,0.5,1,1\n2026-01-01,m,B,6,0.6,2,2\n")
    out = media.share_of_voice(files.read_csv(spark, sov), files.read_csv(spark, mom)).orderBy("candidato").collect()
    a, b = out
    assert (a["menciones"], float(a["share_of_voice"]), float(a["rolling_7"])) == (2, 0.2, 1.5)
    # B is only on the right: its first row gives the counts, its last the rolling figures
    assert (b["menciones"], float(b["rolling_7"]), float(b["momentum"])) == (5, 2.0, 2.0)


def test_landing(spark, tmp_path):
    path = write(tmp_path / "l.csv", "a,b\n1,\n,2\n3,4\n")
    rows = files.landing_rows(files.read_csv(spark, path), "r", "twitter").orderBy("row_number").collect()
    assert [(r["row_number"], r["payload"]) for r in rows] == [
        (1, '{"a":"1","b":null}'), (2, '{"a":null,"b":"2"}'), (3, '{"a":"3","b":"4"}')]
    assert rows[0]["original_filename"] == "l.csv"


def test_inbox_listing_and_paths(spark, tmp_path):
    for name in ("twitter/2026-05-01/a.csv", "tiktok/2026-05-01/run_1_videos.csv", "twitter/mayo/b.csv", "myspace/2026-05-01/c.csv"):
        write(tmp_path / name, "id\n1\n")
    listed = files.list_inbox(spark, f"file:{tmp_path}")
    assert {r["source"] for r in listed.collect()} == {"twitter", "tiktok", "myspace"}
    got = listed.select(files.parse_inbox_path(F.col("path")).alias("p")).where("p is not null").select("p.*").collect()
    assert {(r["source"], r["name"], r["is_videos"]) for r in got} == {
        ("twitter", "a.csv", False), ("tiktok", "run_1_videos.csv", True)}
    assert files.settled(listed, F.current_timestamp(), 3600).count() == 0
    assert files.settled(listed, F.current_timestamp(), -60).count() == 4


def test_jsonl_round_trip(spark, tmp_path):
    row = ("tw_1", "twitter", "1", "2026-01-01", "u", "hola", None, {"likes": 1}, {"q": "x"}, None)
    df = spark.createDataFrame([row, ("yt_1", "youtube", *row[2:])], schemas.BRONZE_POST)
    tables.append_jsonl(df, str(tmp_path / "b"), "2026-01-02")
    tables.append_jsonl(df, str(tmp_path / "b"), "2026-01-03")
    assert files.read_bronze_jsonl(spark, str(tmp_path / "b")).count() == 4
    one = files.read_bronze_jsonl(spark, str(tmp_path / "b"), "twitter", "2026-01-03").collect()
    assert len(one) == 1 and one[0]["engagement"] == {"likes": 1}
    assert files.read_bronze_jsonl(spark, str(tmp_path / "missing")).count() == 0
    assert {tuple(r) for r in tables.source_counts(df).collect()} == {("twitter", 1), ("youtube", 1)}


def test_csv_export_shows_arrays(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"])], "k string, l array<string>")
    tables.write_csv(df, str(tmp_path / "o"))
    assert files.read_csv(spark, str(tmp_path / "o")).select("k", "l").collect()[0][1] == "x, y"


def test_versioned_table(spark, tmp_path):
    schema = schemas.T.StructType([schemas.T.StructField(c, schemas.S) for c in ("id", "v", "run_id")])
    table = tables.VersionedTable(spark, str(tmp_path / "t"), schema, ["id"], ["run_id"])
    make = lambda rows, run: spark.createDataFrame([(*r, run) for r in rows], schema)
    assert table.latest().count() == 0
    table.write(make([("1", "a"), ("2", "a")], "r1"), 1, "r1")
    table.write(make([("2", "b"), ("3", "b")], "r2"), 2, "r2")
    table.write(make([("2", "b"), ("3", "c")], "r2"), 99, "r2")
    state = lambda: {(r["id"], r["v"]) for r in table.latest().collect()}
    assert state() == {("1", "a"), ("2", "b"), ("3", "c")} and len(table.versions()) == 2
    assert table.count_run("r1") == 2 and table.without_run("r2").count() == 2
    table.compact(100)
    assert state() == {("1", "a"), ("2", "b"), ("3", "c")} and len(table.versions()) == 1
    assert table.count_run("r1") == 1
    table.write(make([("1", "z")], "r3"), 101, "r3")
    assert ("1", "z") in state() and len(state()) == 3


def test_cells_follow_the_header_of_their_own_file(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("id,content,likes\n1,hola,5\n")
    (tmp_path / "c" / "b c.csv").write_text("\ufefflikes,ID,content,extra\n7,2,\"adios\nya\",x\n")
    (tmp_path / "c" / "empty.csv").write_text("")
    (tmp_path / "c" / "none.csv").write_text("content\nsolo\n")
    got = files.read_csv(spark, str(tmp_path / "c" / "*.csv"), ["id", "content", "likes"])
    rows = sorted((r["id"] or "", r["content"], r["likes"]) for r in got.collect())
    assert rows == [("", "solo", None), ("1", "hola", "5"), ("2", "adios\nya", "7")]
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.csv").write_text("id,text,date,author\n1,uno,2024-01-01,ana\n")
    (tmp_path / "x" / "b.csv").write_text("author,date,text,id\nbea,2024-01-02,dos,2\n")
    good, _ = mappers.map_posts(files.read_csv(spark, str(tmp_path / "x" / "*.csv")), "external")
    assert sorted((r["id"], r["text"], r["username"]) for r in good.collect()) == [("ext_1", "uno", "ana"), ("ext_2", "dos", "bea")]


def test_external_files_with_unlike_names_are_mapped_each_by_its_header(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.csv").write_text("id,text,date,author\n1,uno,2024-01-01,ana\n,sin,2024-01-03,\n")
    (tmp_path / "x" / "b.csv").write_text("mensaje,fecha,usuario\ndos,2024-01-02,bea\ntres,,\n")
    (tmp_path / "x" / "c.csv").write_text("body,datetime,text,username\nno,2024-01-04,cuatro,eva\n")
    good, bad = mappers.map_posts(files.read_csv(spark, str(tmp_path / "x" / "*.csv")), "external")
    rows = {r["text"]: r for r in good.collect()}
    assert {t: (r["datetime_utc"], r["username"]) for t, r in rows.items()} == {
        "uno": ("2024-01-01", "ana"), "sin": ("2024-01-03", None), "dos": ("2024-01-02", "bea"), "tres": (None, None),
        "cuatro": ("2024-01-04", "eva")}
    assert rows["uno"]["id"] == "ext_1" and "ext_" not in {r["id"] for r in rows.values()}
    assert len({r["id"] for r in rows.values()}) == 5 and bad.count() == 0
    landed = files.landing_rows(files.read_csv(spark, str(tmp_path / "x" / "b.csv")), "r", "external").orderBy("row_number")
    assert landed.first()["payload"] == '{"mensaje":"dos","fecha":"2024-01-02","usuario":"bea"}'


def test_equal_external_rows_without_ids_all_stay(spark, tmp_path):
    for name in ("a b.csv", "copy.csv"):
        (tmp_path / name).write_text("body,fecha\nuno,2026-01-01\nuno,2026-01-01\ndos,\n")
    (tmp_path / "other.csv").write_text("id,text\n,uno\n,uno\n7,tres\n")
    ids = lambda name: sorted((r["text"], r["id"]) for r in mappers.map_posts(files.read_csv(spark, str(tmp_path / name)), "external")[0].collect())
    one = ids("a b.csv")
    assert len(set(one)) == 3 and one == ids("copy.csv") and all(len(i) == 4 + 64 for _, i in one)
    other = ids("other.csv")
    assert len({i for _, i in other}) == 3 and ("tres", "ext_7") in other and sorted(ids("*.csv")) == sorted(one * 2 + other)
    plain = mappers.map_posts(spark.createDataFrame([("x",), ("x",)], "text string"), "external")[0]
    assert plain.select("id").distinct().count() == 2


def test_rows_of_a_split_file_are_numbered_on(spark, tmp_path):
    (tmp_path / "big.csv").write_text("k,v\n" + "".join(f"{i},{'x' * 90}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        rows = files.with_row_numbers(files.read_csv(spark, str(tmp_path / "big.csv"), multi_line=False))
        assert rows.select((F.col("row_number") - F.col("k")).alias("d")).distinct().collect()[0][0] == 1
        assert rows.agg(F.max("row_number")).first()[0] == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_compactions_repeat_and_keep_runs_apart(spark, tmp_path):
    schema = schemas.T.StructType([schemas.T.StructField(c, schemas.S) for c in ("id", "v")])
    table = tables.VersionedTable(spark, str(tmp_path / "t"), schema, ["id"])
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    state = lambda df: {(r["id"], r["v"]) for r in df.collect()}
    table.write(make(("1", "a"), ("2", "a")), 1, "r1")
    table.compact(10)
    table.write(make(("2", "b"), ("3", "b")), 2, "r2")
    table.compact(10)
    table.compact(10)
    assert state(table.latest()) == {("1", "a"), ("2", "b"), ("3", "b")} and len(table.versions()) == 1
    assert state(table.without_run("r2").select("id", "v")) == {("1", "a")} and state(table.run("r2")) == {("2", "b"), ("3", "b")}
    table.write(make(("4", "c")), 3, "r3")
    table.write(make(("3", "z")), 77, "r2")
    assert state(table.run("r2")) == {("3", "z")} and state(table.latest()) == {("1", "a"), ("3", "z"), ("4", "c")}
    table.compact(11)
    assert state(table.latest()) == {("1", "a"), ("3", "z"), ("4", "c")}
    table.vacuum()
    assert state(table.latest()) == {("1", "a"), ("3", "z"), ("4", "c")} and len(table._found("_SUCCESS")) == 1


def test_a_write_that_breaks_off_leaves_what_was_there(spark, tmp_path):
    schema = schemas.T.StructType([schemas.T.StructField(c, schemas.S) for c in ("id", "v")])
    table = tables.VersionedTable(spark, str(tmp_path / "t"), schema, ["id"])
    table.write(spark.createDataFrame([("1", "a")], schema), 1, "r1")
    bad = spark.createDataFrame([("1", "b")], schema).withColumn("v", F.raise_error(F.lit("boom")))
    for _ in range(2):
        try:
            table.write(bad, 1, "r1")
        except Exception:  # noqa: BLE001
            pass
        assert table.latest().first()["v"] == "a"


def digests(spark, *paths):
    return {r["file_path"].rsplit("/", 1)[-1]: r["source_sha256"] for r in files.fingerprints(spark, list(paths)).collect()}


def test_large_files_are_hashed_by_line_whatever_their_splits(spark, tmp_path, monkeypatch):
    lines = [f"{i},café {i}\r" for i in range(400)]
    swapped, changed = [*lines[:7], lines[8], lines[7], *lines[9:]], [*lines[:399], "399,cafe 399\r"]
    contents = {"a.csv": lines, "b.csv": lines, "swapped.csv": swapped, "changed.csv": changed, "open.csv": lines, "small.csv": lines[:3]}
    paths = [write(tmp_path / n, ("\n".join(c) + ("" if n == "open.csv" else "\n")).encode(), "wb") for n, c in contents.items()]
    monkeypatch.setattr(files, "WHOLE_FILE", 1000)
    one = digests(spark, *paths)
    assert len(one) == 6 and one["a.csv"] == one["b.csv"] and len(set(one.values())) == 5
    assert one["small.csv"] == hashlib.sha256((tmp_path / "small.csv").read_bytes()).hexdigest()
    assert one["a.csv"] != hashlib.sha256((tmp_path / "a.csv").read_bytes()).hexdigest()  # no task has its bytes
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        assert spark.read.text(paths[0]).rdd.getNumPartitions() > 4 and digests(spark, *paths) == one
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ids_of_rows_in_large_files_are_given_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "WHOLE_FILE", 50)
    paths = [write(tmp_path / n, "mensaje,fecha\n" + "igual,2026-01-01\n" * 20) for n in ("uno.csv", "dos.csv")]
    ids = [{r["id"] for r in mappers.map_posts(files.read_csv(spark, p), "external")[0].collect()} for p in paths]
    assert len(ids[0]) == 20 and ids[0] == ids[1]


def test_exports_of_larger_tables_are_more_files(spark, tmp_path, monkeypatch):
    from agoralake.queries import layers as queries
    spark.range(1000).write.parquet(str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in"))
    assert queries._write_exports(rows, str(tmp_path / "few"), 2) == 2 and len(list((tmp_path / "few").glob("*.csv"))) == 2
    size = sum(p.stat().st_size for p in (tmp_path / "in").glob("*.parquet"))
    monkeypatch.setattr(queries, "EXPORT_BYTES", -(-size // 5))
    n = queries._write_exports(rows, str(tmp_path / "more"), 2)
    assert n == 5 and len(list((tmp_path / "more").glob("*.csv"))) == 5
    assert queries._write_exports(rows, str(tmp_path / "one"), 1, more=False) == 1
