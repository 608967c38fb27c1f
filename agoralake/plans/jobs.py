"""Batch jobs over the lake: file -> raw -> silver -> gate -> gold, videos, media, and the analysis.

Each stage is one Spark write whose result the next stage reads, so a lost executor costs a stage's tasks. A log says which
stage every file has reached: a run that breaks off is finished by the next one over the same files, from the stage it was in.
Nothing is collected but row counts, verdicts, names of broken runs and the days a batch touches.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from agoralake import schemas
from agoralake.functions.casting import lenient_timestamp
from agoralake.operators import feature_table, windows
from agoralake.operators.dedupe import dedupe, dedupe_few, union_by_priority
from agoralake.operators.quality import alerts, report, summary
from agoralake.plans import layers, rollups, scorers
from agoralake.plans.filelog import STAGES, FileLog
from agoralake.plans.ledger import Ledger, new_run_id, now_micros
from agoralake.session import freeing, stored as work_table
from agoralake.sources import files, mappers, media, tables
from agoralake.sources.ids import IdIndex
from agoralake.sources.tables import VersionedTable

CONTEXTS = ("posts", "posts_parlamentarias")
_VIDEOS = "_videos.csv"
_ANY_CASE_VIDEOS = "*_[vV][iI][dD][eE][oO][sS].[cC][sS][vV]"
_DAY = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"


QUARANTINE = schemas.T.StructType([
    *[schemas.T.StructField(c, schemas.S) for c in ("run_id", "source", "file_path", "error", "payload")],
    schemas.T.StructField("file_order", schemas.L)])


def _with(schema: schemas.T.StructType, *names: str) -> schemas.T.StructType:
    return schemas.T.StructType([*schema.fields, *[schemas.T.StructField(n, schemas.S) for n in names]])


LANDING = schemas.T.StructType([
    *[schemas.T.StructField(c, schemas.S) for c in ("run_id", "source", "original_filename", "payload")],
    schemas.T.StructField("row_number", schemas.L)])
ALERT = schemas.T.StructType([
    *[schemas.T.StructField(c, schemas.S) for c in ("run_id", "severity", "channel", "payload")],
    schemas.T.StructField("delivered", schemas.B), schemas.T.StructField("created_at", schemas.TS)])


def event_day(at: Column) -> Column:
    """The day a post belongs to in stored tables; NULL without a time."""
    return F.date_format(at, "yyyy-MM-dd")


def by_day(rows: DataFrame) -> DataFrame:
    """Rows of a day in few files; a day with very many rows in several."""
    return rows.hint("rebalance", "event_day")


def _few(name: str) -> Callable[..., DataFrame]:
    return partial(dedupe_few, store=lambda df: work_table(df, name))


def posts_by_day(posts: DataFrame) -> DataFrame:
    """``by_day`` for posts whose time may still be text."""
    at = F.col("datetime_utc")
    day = event_day(lenient_timestamp(at) if isinstance(posts.schema["datetime_utc"].dataType, schemas.T.StringType) else at)
    return by_day(posts.withColumn("event_day", day)).drop("event_day")


def quarantine_rows(bad: DataFrame, run_id: str, source: str) -> DataFrame:
    """Rejected rows in the shape of the quarantine table; the whole row is kept as JSON."""
    path = F.col("file_path") if "file_path" in bad.columns else F.lit(None).cast("string")
    order = F.col("file_order") if "file_order" in bad.columns else F.lit(None).cast("bigint")
    error = F.col("error") if "error" in bad.columns else F.lit("id missing")
    return bad.select(F.lit(run_id).alias("run_id"), F.lit(source).alias("source"), path.alias("file_path"), error.alias("error"),
                      F.to_json(F.struct("*")).alias("payload"), order.alias("file_order"))


def verdict_of(found: dict) -> dict:
    """A report's summary as the ledger keeps it."""
    return {"overall": found["overall"], "total_records": found["total_records"], **found["checks"]}


@dataclasses.dataclass
class Lake:
    """Where the tables of one deployment live."""

    spark: SparkSession
    root: str

    def _table(self, name: str, schema, keys: Sequence[str], partition_by: Sequence[str] = (), arrange=None) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root.rstrip('/')}/{name}", schema, keys, partition_by, arrange)

    def raw(self, context: str = "posts") -> VersionedTable:
        return self._table(f"raw/{context}", schemas.RAW_POST, ["id"], ["source"])

    def files(self, context: str = "posts") -> FileLog:
        """Which files have been taken and how far they have come: a few small rows per file."""
        return FileLog(self.spark, f"{self.root.rstrip('/')}/ops/files_{context}")

    def silver(self, context: str = "posts") -> VersionedTable:
        """By month of cleaning and day of the post; both are part of the key, so filters on them prune folders."""
        return self._table(f"silver/{context}", _with(schemas.SILVER_POST, "cleaned_month", "event_day"),
                           ["cleaned_month", "event_day", "id", "cleaned_at"], ["cleaned_month", "event_day"], by_day)

    def ids(self, context: str = "posts") -> IdIndex:
        """Ids of silver posts, for the question which of a batch are known."""
        return IdIndex(self.spark, f"{self.root.rstrip('/')}/ops/silver_ids_{context}")

    def gold(self) -> VersionedTable:
        return self._table("gold/features", _with(schemas.GOLD_FEATURE, "event_day"), ["event_day", "id"], ["event_day"], by_day)

    def sentiment(self) -> rollups.AdditiveView:
        return rollups.sentiment_view(self.spark, f"{self.root.rstrip('/')}/public/sentiment_daily_sums")

    def landing(self) -> VersionedTable:
        """Whole rows of files of any layout."""
        return self._table("ops/landing", LANDING, ["run_id", "original_filename", "row_number"])

    def alerts(self) -> VersionedTable:
        """What somebody has to be told about: one row per report that is not PASS."""
        return self._table("ops/alerts", ALERT, ["run_id", "payload"])

    def videos(self, source: str) -> VersionedTable:
        return self._table(f"raw/{source}_videos", media.VIDEO_SCHEMAS[source], ["video_id"])

    def media(self, name: str) -> VersionedTable:
        schema, keys = {
            "mentions": (schemas.MENTIONS, media.MENTION_KEYS),
            "share_of_voice": (schemas.SHARE_OF_VOICE, media.VOICE_KEYS),
            "momentum": (schemas.SHARE_OF_VOICE, media.VOICE_KEYS),
            "vote_intentions": (schemas.VOTE_INTENTIONS, media.MENTION_KEYS),
        }[name]
        return self._table(f"media/{name}", schema, keys)

    def quarantine(self) -> VersionedTable:
        """Rows that no mapper or check accepted, whole, with the reason."""
        return self._table("ops/quarantine", QUARANTINE, ["run_id", "file_path", "file_order"])

    def reports(self) -> VersionedTable:
        return self._table("ops/quality_reports", schemas.QUALITY_REPORT, ["run_id", "layer"])

    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root.rstrip('/')}/ops/pipeline_runs")


# --- stages -----------------------------------------------------------------------------------------------------------

def read_source(spark: SparkSession, paths: str | Sequence[str], source: str) -> DataFrame:
    if source == "fb_parlamentarias":
        return files.read_nested_csv(spark, paths)
    return files.read_csv(spark, paths)


def _same_spelling(df: DataFrame) -> DataFrame:
    """Scans spell local paths in two ways."""
    return df.withColumn("file_path", F.regexp_replace("file_path", r"^file:/+", "file:/"))


def take_files(lake: Lake, paths: str | Sequence[str], run_id: str, seq: int, context: str = "posts", goal: str = "silver",
               skip_suffix: str | None = None) -> list[tuple[str, str, str]]:
    """A run takes the files that no other run has stored; copies count once. Returns (run, goal, stage) of the runs that have
    stored one of the files and broke off before its end.

    A run that had only seen its files may have stored them all the same: then its raw rows are there.
    """
    log, raw = lake.files(context), lake.raw(context)
    hashed = files.fingerprints(lake.spark, paths)
    if skip_suffix is not None:
        hashed = hashed.where(~F.endswith(F.lower("file_path"), F.lit(skip_suffix)))
    hashed = dedupe(hashed, ["source_sha256"], ["file_path"], "first")
    known = hashed.join(log.state(hashed, run_id), "source_sha256", "left")
    runs = known.where(F.col("stage") != "done").select("run_id", "goal", "stage").distinct().collect()
    stored = set(raw.runs()) if runs else set()
    for r in runs:
        if r["stage"] == "seen" and r["run_id"] in stored:
            log.reach(r["run_id"], "bronze", seq)
    broken = [(r["run_id"], r["goal"], "bronze" if r["stage"] == "seen" else r["stage"]) for r in runs if r["run_id"] in stored]
    lost = [r["run_id"] for r in runs if r["run_id"] not in stored]  # nothing of theirs was stored: their files are new
    log.see(known.where(F.col("run_id").isNull() | (F.col("run_id").isin(lost) & (F.col("stage") != "done"))), run_id, goal, seq)
    return sorted(broken)


def store_bronze(lake: Lake, source: str, run_id: str, seq: int, context: str = "posts") -> int:
    """The files a run has taken into the raw table; no other file is read. Returns rows written."""
    raw, log = lake.raw(context), lake.files(context)
    new = log.files_of(run_id).select("file_path", "source_sha256")
    taken = sorted(r["file_path"] for r in new.collect())  # one row per file, as in any file listing
    if source not in mappers.MAPPERS or not taken:
        return 0
    good, bad = mappers.map_posts(read_source(lake.spark, taken, source), source)
    rows = _same_spelling(good).join(_same_spelling(new), "file_path")  # each row gets the hash of its file
    lake.quarantine().write(quarantine_rows(bad, run_id, source), seq, run_id)
    unique = dedupe(rows, ["id"], ["file_path", "file_order"])
    raw.write(mappers.raw_rows(unique, run_id, F.current_timestamp(), sha256=F.col("source_sha256")), seq, run_id)
    log.reach(run_id, "bronze", seq)
    return raw.count_run(run_id)


def load_bronze(lake: Lake, paths: str | Sequence[str], source: str, run_id: str, seq: int,
                context: str = "posts", skip_suffix: str | None = None) -> int:
    """New files of one source into the raw table; a file whose bytes are known is skipped. Returns rows written."""
    if source not in mappers.MAPPERS:
        return 0
    take_files(lake, paths, run_id, seq, context, skip_suffix=skip_suffix)
    return store_bronze(lake, source, run_id, seq, context)


def known_ids(lake: Lake, posts: DataFrame, run_id: str, seq: int, context: str = "posts") -> DataFrame:
    """Ids of earlier runs that ``posts`` repeat. A lake whose silver is older than its id index gets the index first."""
    ids, silver = lake.ids(context), lake.silver(context)
    if not ids.table.versions() and silver.versions():
        ids.add(silver.without_run(run_id), f"ids-before-{run_id}", seq)
    return ids.known(posts, run_id)


def store_silver(lake: Lake, good: DataFrame, run_id: str, seq: int, context: str = "posts", arranged: bool = False) -> None:
    """A run's silver rows, then their ids: ids that are known have rows. ``arranged`` rows have been dealt out by day."""
    silver = lake.silver(context)
    silver.write(good.withColumn("cleaned_month", F.date_format("cleaned_at", "yyyy-MM")).withColumn(
        "event_day", event_day(F.col("datetime_utc"))), seq, run_id, arranged)
    lake.ids(context).add(silver.run(run_id), run_id, seq)


def promote_silver(lake: Lake, run_id: str, seq: int, context: str = "posts", mask_first: bool = False,
                   detector: Callable[[str], str] | None = None) -> int:
    silver = lake.silver(context)
    posts = mappers.posts_of_raw(lake.raw(context).run(run_id))
    seen = work_table(known_ids(lake, posts, run_id, seq, context), "known-ids")
    good, _ = layers.to_silver(posts, seen, run_id, F.current_timestamp(), mask_first=mask_first, detector=detector,
                               one_of=_few("repeated-ids"), arrange=posts_by_day)
    store_silver(lake, good, run_id, seq, context, arranged=True)
    return silver.count_run(run_id)


def run_gate(lake: Lake, run_id: str, seq: int, layer: str = "silver", context: str = "posts",
             as_of: Column | None = None) -> dict:
    """Check a run's silver rows, store the report and return its compact summary."""
    posts = lake.silver(context).run(run_id)
    row = report(posts, lake.ledger().runs(), run_id, layer, F.current_timestamp() if as_of is None else as_of)
    lake.reports().write(row, seq, f"{layer}-{run_id}")
    stored = lake.reports().run(f"{layer}-{run_id}")
    lake.alerts().write(alerts(stored), seq, f"{layer}-{run_id}")
    return summary(stored).first().asDict()


def promote_gold(lake: Lake, run_id: str, seq: int, context: str = "posts", refresh: bool = False,
                 parity_flags: bool = False) -> int:
    gold = lake.gold()
    posts = lake.silver(context).run(run_id)
    rows = layers.to_gold(posts, run_id, F.current_timestamp(), parity_flags)
    gold.write(rows.withColumn("event_day", event_day(F.col("datetime_utc"))), seq, run_id)
    if refresh:
        refresh_views(lake, again=[run_id])
    return gold.count_run(run_id)


def write_scores(lake: Lake, results: DataFrame, days: Sequence[str | None], run_id: str, seq: int | None = None) -> int:
    """Model results (id, sentiment_label, sentiment_score, candidate_mentioned) into gold. Returns rows changed.

    ``days`` are the event days the results may be of: only those are read, and only rows that have a result are written, as a
    version that replaces theirs. Ids without a gold row are passed over.
    """
    gold = lake.gold()
    if not gold.versions():
        return 0
    inside = F.col("event_day").isin([d for d in days if d is not None])
    rows = gold.latest().where(inside | F.col("event_day").isNull() if None in days else inside)
    slots = ["sentiment_label", "sentiment_score", "candidate_mentioned"]
    found = rows.drop(*slots).join(dedupe(results.select("id", *slots), ["id"], slots), "id")
    gold.write(found, now_micros() if seq is None else seq, f"scores-{run_id}")
    refresh_views(lake)
    return gold.count_run(f"scores-{run_id}")


def run_landing(lake: Lake, paths: str | Sequence[str], source: str, run_id: str | None = None) -> dict:
    """Files of any layout, whole rows, and how many rows the run has."""
    ledger, seq = lake.ledger(), now_micros()
    run_id = ledger.start("landing", run_id=run_id)
    try:
        lake.landing().write(files.landing_rows(files.read_csv(lake.spark, paths), run_id, source), seq, run_id)
        n = lake.landing().count_run(run_id)
        ledger.finish(run_id, "success", rows_out=n)
        return {"run_id": run_id, "status": "success", "rows": n}
    except Exception as exc:
        ledger.finish(run_id, "failed", error=str(exc))
        raise


def _tables(lake: Lake, context: str) -> list[VersionedTable]:
    return [lake.raw(context), lake.silver(context), lake.gold(), lake.reports(), lake.quarantine(), lake.alerts(), lake.landing(),
            lake.files(context).table, lake.ids(context).table, lake.ledger().table]


def compact(lake: Lake, context: str = "posts") -> None:
    """Fold the folders of all tables; for a quiet hour, as it reads each table once."""
    seq = now_micros()
    for table in _tables(lake, context):
        table.compact(seq)


def tidy(lake: Lake, context: str = "posts") -> int:
    """Fold the tables that are due; jobs do so after a run. Returns how many were."""
    seq = now_micros()
    view = lake.sentiment()
    if len(view.changes.versions()) >= FOLD_AFTER:
        view.fold()
    return sum(table.compact_when_due(seq) for table in _tables(lake, context))


FOLD_AFTER = 64


def refresh_views(lake: Lake, again: Sequence[str] = ()) -> None:
    """Bring the daily view up to date with gold: each run it has not counted yet is added, less the rows the run replaced.

    Only the days a run touches are read. ``again`` are runs whose rows may have changed since they were counted.
    """
    gold, view = lake.gold(), lake.sentiment()
    order, done = gold.runs(), view.batches() - set(again)
    for i, run in enumerate(order):
        if run in done:
            continue
        new, earlier = gold.run(run), set(order[:i])
        days = [r["event_day"] for r in new.where("event_day is not null").select("event_day").distinct().collect()]
        old = gold.latest(lambda r: r in earlier).where(F.col("event_day").isin(days)).join(new.select("event_day", "id"), ["event_day", "id"], "left_semi")
        view.apply(run, rollups.with_day(new), rollups.with_day(old) if earlier and days else None)
    tables.refresh_daily(rollups.sentiment_daily(view.totals()), f"{lake.root.rstrip('/')}/public/v_sentiment_daily")


# --- jobs -------------------------------------------------------------------------------------------------------------

def finish_run(lake: Lake, run_id: str, seq: int, reached: str, goal: str, context: str = "posts", gate: bool = True,
               as_of: Column | None = None, mask_first: bool = False) -> dict:
    """Take a run whose files have reached a stage to its end: silver, gate, gold, ledger. Returns status, rows and verdict."""
    log, at = lake.files(context), STAGES.index(reached)
    before = lambda stage: at < STAGES.index(stage)
    out = {"run_id": run_id, "status": "running", "rows_silver": 0, "rows_gold": 0, "quality_overall": None}

    def done(status: str, rows: int, verdict: dict | None = None) -> dict:
        lake.ledger().finish(run_id, status, rows_out=rows, quality_summary=verdict)
        log.reach(run_id, "done", seq)  # last: a run without this mark is finished again, which changes nothing
        out["status"] = status
        return out

    if before("silver"):
        promote_silver(lake, run_id, seq, context, mask_first)
        log.reach(run_id, "silver", seq)
    out["rows_silver"] = lake.silver(context).count_run(run_id)
    if out["rows_silver"] == 0:
        return done("success", 0)
    verdict = None
    if gate:
        if before("gate"):
            found = run_gate(lake, run_id, seq, context=context, as_of=as_of)
            log.reach(run_id, "gate", seq)
        else:
            found = summary(lake.reports().run(f"silver-{run_id}")).first().asDict()
        out["quality_overall"] = found["overall"]
        verdict = verdict_of(found)
        if found["overall"] == "FAIL":
            return done("quality_failed", 0, verdict)
    if goal != "gold":
        return done("success", out["rows_silver"], verdict)
    if before("gold"):
        promote_gold(lake, run_id, seq, context)
        log.reach(run_id, "gold", seq)
    out["rows_gold"] = lake.gold().count_run(run_id)
    refresh_views(lake, again=[run_id])
    return done("success", out["rows_gold"], verdict)


def resume_runs(lake: Lake, broken: Sequence[tuple[str, str, str]] | None = None, context: str = "posts", **options) -> list[dict]:
    """Finish broken runs, each under its own name; without a list all that the log of files has."""
    if broken is None:
        rows = lake.files(context).state().where(~F.col("stage").isin("seen", "done")).select("run_id", "goal", "stage").distinct().collect()
        broken = sorted((r["run_id"], r["goal"], r["stage"]) for r in rows)
    out = []
    for run_id, goal, stage in broken:
        try:
            out.append(finish_run(lake, run_id, now_micros(), stage, goal, context, **options))
        except Exception as exc:
            lake.ledger().finish(run_id, "failed", error=str(exc))
            raise
    return out


@freeing
def run_batch(lake: Lake, paths: str | Sequence[str], source: str, *, skip_gold: bool = True, gate: bool = True,
              context: str = "posts", as_of: Column | None = None, mask_first: bool = False,
              flow_name: str | None = None, run_id: str | None = None, seq: int | None = None,
              skip_suffix: str | None = None) -> dict:
    """Files of one source through the layers. Returns run id, status, rows per layer, the verdict, and the runs it finished.

    PASS and WARN continue, FAIL stops before gold. The second context has no gold stage. Runs over the same files that broke
    off are finished first, under their own names. A caller that may repeat a batch passes ``run_id`` and ``seq``, so the
    repeat overwrites the first attempt.
    """
    ledger = lake.ledger()
    skip_gold = skip_gold or context != "posts"
    goal = "silver" if skip_gold else "gold"
    seq = now_micros() if seq is None else seq
    run_id = ledger.start(flow_name or ("e2e_silver_only" if skip_gold else "e2e"), run_id=run_id)
    out = {"run_id": run_id, "status": "running", "rows_bronze": 0, "rows_silver": 0, "rows_gold": 0,
           "quality_overall": None, "resumed": []}
    try:
        if source in mappers.MAPPERS:
            broken = take_files(lake, paths, run_id, seq, context, goal, skip_suffix)
            out["resumed"] = resume_runs(lake, broken, context, gate=gate, as_of=as_of, mask_first=mask_first)
            out["rows_bronze"] = store_bronze(lake, source, run_id, seq, context)
        if out["rows_bronze"] == 0:
            ledger.finish(run_id, "success", rows_out=0)
            if source in mappers.MAPPERS:
                lake.files(context).reach(run_id, "done", seq)
            out["status"] = "success"
        else:
            out.update(finish_run(lake, run_id, seq, "bronze", goal, context, gate, as_of, mask_first))
        tidy(lake, context)
        return out
    except Exception as exc:
        ledger.finish(run_id, "failed", error=str(exc))
        out["status"] = "failed"
        raise


def run_videos(lake: Lake, paths: str | Sequence[str], source: str, run_id: str | None = None,
               seq: int | None = None) -> dict:
    """Video metadata; a later load of a video refreshes its row."""
    if source not in media.VIDEO_MAPPERS:
        return {"run_id": None, "status": "skipped", "rows": 0}
    ledger = lake.ledger()
    seq = now_micros() if seq is None else seq
    run_id = ledger.start("ingest_videos", run_id=run_id)
    try:
        rows, bad = media.VIDEO_MAPPERS[source](files.read_csv(lake.spark, paths), run_id)
        lake.quarantine().write(quarantine_rows(bad, run_id, f"{source}_videos"), seq, run_id)
        table = lake.videos(source)
        table.write(dedupe(rows, ["video_id"], ["file_path", "file_order"]), seq, run_id)
        n = table.count_run(run_id)
        ledger.finish(run_id, "success", rows_out=n)
        return {"run_id": run_id, "status": "success", "rows": n}
    except Exception as exc:
        ledger.finish(run_id, "failed", error=str(exc))
        raise


def run_inbox(lake: Lake, inbox: str, **options) -> list[dict]:
    """Every file of an inbox: one batch per source and kind, whatever the number of files.

    Only the (source, kind) pairs present come to the driver; the files themselves are read by one scan per pair.
    """
    base = inbox.rstrip("/")
    found = files.list_inbox(lake.spark, base).select(files.parse_inbox_path(F.col("path")).alias("p")).where(
        F.col("p").isNotNull())
    pairs = found.select("p.source", "p.is_videos").distinct().orderBy("source", "is_videos").collect()
    results = []
    for source, is_videos in pairs:
        pattern = f"{base}/{source}/{_DAY}/*.[cC][sS][vV]"
        try:
            if is_videos:
                one = run_videos(lake, f"{base}/{source}/{_DAY}/{_ANY_CASE_VIDEOS}", source)
            else:
                one = run_batch(lake, pattern, source, skip_suffix=_VIDEOS, **options)
        except Exception as exc:  # noqa: BLE001 - the ledger has the failure; other sources go on
            one = {"status": "failed", "error": str(exc)}
        results.append({"source": source, "videos": is_videos, **one})
    return results


def run_media(lake: Lake, mentions: str | None = None, sov: str | None = None, momentum: str | None = None,
              votes: str | None = None) -> DataFrame:
    """Load the media tables at hand; rows loaded per table."""
    spark, seq, run_id = lake.spark, now_micros(), new_run_id()
    article, voice = ["article_id", "medio", "fecha", "candidato"], ["fecha", "medio", "candidato"]
    loaded: dict[str, DataFrame] = {}

    if mentions:
        loaded["mentions"] = _unique(files.read_required(spark, mentions, article), media.mentions, media.MENTION_KEYS)
    moving = files.read_required(spark, momentum, voice) if momentum else None
    if sov:
        loaded["share_of_voice"] = media.share_of_voice(files.read_required(spark, sov, voice), moving)
    if moving is not None:
        loaded["momentum"] = _unique(moving, media.momentum, media.VOICE_KEYS)
    if votes:
        loaded["vote_intentions"] = _unique(
            files.read_required(spark, votes, article), media.vote_intentions, media.MENTION_KEYS)
    counts = []
    for name, df in loaded.items():
        lake.media(name).write(df, seq, run_id)
        counts.append(lake.media(name).run(run_id).agg(F.count(F.lit(1)).alias("filas")).select(
            F.lit(name).alias("tabla"), "filas"))
    if not counts:
        return spark.createDataFrame([], "tabla string, filas bigint")
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def _unique(df: DataFrame, mapper: Callable[[DataFrame], DataFrame], keys: Sequence[str]) -> DataFrame:
    """Map, keeping the last row of each key in file order."""
    trimmed = {k: (F.substring(k, 1, 10) if k == "fecha" else F.trim(F.coalesce(k, F.lit("")))) for k in keys}
    return mapper(dedupe(df.withColumns(trimmed), list(keys), ["file_order"]))


def load_contexts(lake: Lake, since: Column | None = None, cleaned_after: Column | None = None) -> DataFrame:
    """Silver posts of both contexts, the first context winning on equal ids.

    With ``since`` only posts from that time on, and with ``cleaned_after`` also older ones that came in later than that. Both
    are first said in terms of stored folders, so other days are not read.
    """
    def rows(context: str) -> DataFrame:
        table = lake.silver(context).latest()
        if since is not None:
            folders = F.col("event_day") >= event_day(since)
            wanted = F.col("datetime_utc") >= since
            if cleaned_after is not None:
                folders |= F.col("cleaned_month") >= F.date_format(cleaned_after, "yyyy-MM")
                wanted = F.coalesce(wanted, F.lit(False)) | (F.col("cleaned_at") > cleaned_after)
            table = table.where(folders).where(wanted)
        return table.where(~F.col("is_duplicate")).drop("cleaned_month")
    return union_by_priority([rows(c) for c in CONTEXTS], ["id"], ["cleaned_at"], _few("ids-of-both"))


def scored_posts(lake: Lake, schema: schemas.T.StructType) -> VersionedTable:
    """Scored posts by day; of equal text and time the newest row counts."""
    return lake._table("analysis/scored_posts", _with(schema, "event_day"), ["event_day", "texto_usuario_norm", "fecha"], ["event_day"], by_day)


# Classes of the analysis and the labels of gold.
TEXT_FORMS = ["texto_usuario", "texto", "texto_usuario_norm", "texto_norm"]
GOLD_LABELS = {"positivo": "positive", "negativo": "negative", "neutro": "neutral"}


def model_results(scored: DataFrame) -> DataFrame:
    """Scored posts as gold's model columns."""
    label = F.lit(None).cast("string")
    for own, name in GOLD_LABELS.items():
        label = F.when(F.col("sentimiento") == own, F.lit(name)).otherwise(label)
    return scored.select("id", label.alias("sentiment_label"), F.col("score").alias("sentiment_score"),
                         layers.candidate_slot("candidatos").alias("candidate_mentioned"))


@freeing
def run_analysis(lake: Lake, scorer: scorers.TextScorer, polls: DataFrame | None = None,
                 momentum: DataFrame | None = None, period: tuple[str, str] | None = None,
                 since: Column | None = None, resume: bool = False, write_back: bool = True) -> dict[str, DataFrame]:
    """Standardise, score, aggregate in windows and build the feature table.

    Scored posts are written once and read back, so every later step starts from stored columns. The four forms of a text stand
    next to each other there, which compresses to little more than one; ``contexts`` has no texts. With ``resume`` only posts
    from the stored high-water marks on are scored (by time of the post, and late ones by time of cleaning); they join the
    scored posts of earlier runs. Scores go back to the gold rows of the days that were scored, and the daily view follows.
    Texts the scorer fails on go to the quarantine, weigh in no mean, and their number is in the ledger.
    """
    root, run_id = lake.root.rstrip("/"), new_run_id()
    path, marks = f"{root}/analysis/{run_id}", f"{root}/ops/high_water_mark"

    def stored(name: str, df: DataFrame, alike: Sequence[str] = ()) -> DataFrame:
        """``alike`` columns are written as one array."""
        rows = df.withColumn("_alike", F.array(*alike)).drop(*alike) if alike else df
        rows.write.option("compression", "zstd").parquet(f"{path}/{name}")
        back = lake.spark.read.parquet(f"{path}/{name}")
        return back.select(*[F.get("_alike", F.lit(alike.index(c))).alias(c) if c in alike else F.col(c) for c in df.columns])

    cleaned_after = None
    if resume and since is None and files.exists(lake.spark, f"{marks}/*/_SUCCESS"):
        mark = tables.read_daily(lake.spark, marks).first()
        since = None if mark["ultima_fecha"] is None else F.lit(mark["ultima_fecha"])
        cleaned_after = None if mark["ultima_limpieza"] is None else F.lit(mark["ultima_limpieza"])
    posts = load_contexts(lake, since, cleaned_after)  # the same stored rows, however often they are read
    contexts = stored("contexts", posts.drop("text_clean", "text_original"))
    rows = layers.with_intention(layers.standardise(posts))
    counted = Observation(f"scored-{run_id}")
    every = stored("new_scored", scorers.with_sentiment(rows, scorer).observe(
        counted, F.count(F.lit(1)).alias("rows"), F.count("score_error").alias("failed")), TEXT_FORMS)
    scored = every.where("score_error is null").drop("score_error")
    failed = every.where("score_error is not null")
    lake.quarantine().write(quarantine_rows(failed.withColumn("error", F.col("score_error")), run_id, "analysis"), now_micros(), f"analysis-{run_id}")
    lake.ledger().start("analysis", rows_in=counted.get["rows"], run_id=run_id)
    if write_back:
        days = [r["event_day"] for r in contexts.select("event_day").distinct().collect()]
        write_scores(lake, model_results(scored), days, run_id)
    if resume:
        table = scored_posts(lake, scored.schema)
        fresh = dedupe(scored, ["texto_usuario_norm", "fecha"], ["id"]).withColumn("event_day", event_day(F.col("fecha")))
        table.write(fresh, now_micros(), run_id)
        scored = table.latest().drop("event_day")
        last = lambda c, old: F.greatest(F.max(c), F.lit(None).cast("timestamp") if old is None else old.cast("timestamp"))
        tables.refresh_daily(contexts.agg(last("datetime_utc", since).alias("ultima_fecha"),
                                          last("cleaned_at", cleaned_after).alias("ultima_limpieza")).coalesce(1), marks)

    by_candidate = stored("scores_candidato_red", windows.windowed_scores(scored, "candidatos"))
    by_party = stored("scores_partido_red", windows.windowed_scores(scored, "partidos"))
    out = {
        "scored": scored, "scores_candidato_red": by_candidate, "scores_partido_red": by_party,
        "features": stored("features", feature_table.build_feature_table(by_candidate, by_party, polls, momentum)),
        "ranking": windows.ranking(by_candidate),
        "ultima_fecha": files.high_water_mark(contexts),
    }
    if period:
        out["parlamentarias_candidato_red"] = windows.period_scores(scored, "candidatos", *period)
        out["parlamentarias_partido_red"] = windows.period_scores(scored, "partidos", *period)
    n, bad = counted.get["rows"], counted.get["failed"]
    lake.ledger().finish(run_id, "success", rows_out=n - bad, quality_summary={"texts_failed": bad})
    return out
