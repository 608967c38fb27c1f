"""The inbox as a stream of files. Each micro-batch runs the same transforms as the batch jobs.

The stream carries the paths of new files only; each batch reads its files by their own headers, as the batch job does. The
file source remembers in its checkpoint which files it has seen, so a restart adds nothing and no file is taken twice.
Writers should rename finished files into the inbox. Where they cannot, ``quiet`` makes a batch wait until its files have kept
their length and time for so many seconds: the source gives a path once, so what is written later would never be read.

Runs are named after an id kept with the checkpoint, so streams that write to one lake never take each other's place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from agoralake import schemas
from agoralake.operators.dedupe import dedupe
from agoralake.plans import layers
from agoralake.plans.jobs import Lake, known_ids, quarantine_rows, resume_runs, store_silver, take_files, verdict_of
from agoralake.plans.ledger import now_micros
from agoralake.operators.quality import report, summary
from agoralake.sources import files, mappers, media
from agoralake.sources.tables import VersionedTable

# How often the inbox is looked at when the stream runs all the time.
RESCAN = "30 minutes"
_DAY = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
_FILE = "path string, modificationTime timestamp, length long, content binary"


def inbox_stream(spark: SparkSession, inbox: str, source: str, files_per_trigger: int | None = None,
                 archive: str | None = None) -> DataFrame:
    """``path`` of each CSV in ``<inbox>/<source>/<day>/`` as it arrives, oldest first; finished files may be archived.

    Content is not read. Names of any case are taken, files of other kinds are not.
    """
    reader = spark.readStream.format("binaryFile").schema(_FILE).option("latestFirst", "false").option(
        "pathGlobFilter", files.CSV_NAMES)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(f"{inbox.rstrip('/')}/{source}/{_DAY}/").select("path")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that has this checkpoint; a new checkpoint gets a new one."""
    path = f"{checkpoint.rstrip('/')}/agoralake-stream-id"
    if not files.exists(spark, path):
        files.write_small_text(spark, path, uuid.uuid4().hex)
    return files.read_small_text(spark, path)


def _of_kind(batch: DataFrame, videos: bool) -> list[str]:
    """The batch's files; a trigger's paths are few."""
    low = F.lower("path")
    rows = batch.where(F.endswith(low, F.lit("_videos.csv")) == F.lit(videos)).select("path").collect()
    return sorted(r["path"] for r in rows)


def _start(writer: DataStreamWriter, checkpoint: str, once: bool, every: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def post_batch(lake: Lake, source: str, context: str = "posts", stream: str = "inbox") -> Callable[[DataFrame, int], None]:
    """A function of (rows, batch number): rows -> raw -> silver -> report and ledger, rejected rows to quarantine.

    A batch that fails the gate is in the ledger as ``quality_failed``. Re-running a batch replaces what it wrote.
    """
    def handle(rows: DataFrame, batch_id: int) -> None:
        run_id, seq = f"{stream}_{source}_{batch_id}", now_micros()
        raw, silver, reports, ledger = lake.raw(context), lake.silver(context), lake.reports(), lake.ledger()
        ledger.start("stream_silver", run_id=run_id)
        try:
            ordered = rows if "file_order" in rows.columns else rows.withColumn("file_order", F.monotonically_increasing_id())
            good, bad = mappers.map_posts(ordered, source)
            lake.quarantine().write(quarantine_rows(bad, run_id, source), seq, run_id)
            unique = dedupe(good, ["id"], ["file_path", "file_order"])
            raw.write(mappers.raw_rows(unique, run_id, F.current_timestamp()), seq, run_id)
            posts = mappers.posts_of_raw(raw.run(run_id))
            seen = known_ids(lake, posts, run_id, seq, context)
            fresh, _ = layers.to_silver(posts, seen, run_id, F.current_timestamp())
            store_silver(lake, fresh, run_id, seq, context)
            row = report(silver.run(run_id), ledger.runs(), run_id, "silver", F.current_timestamp())
            reports.write(row, seq, f"silver-{run_id}")
            found = summary(reports.run(f"silver-{run_id}")).first().asDict()
            status = "quality_failed" if found["overall"] == "FAIL" else "success"
            ledger.finish(run_id, status, rows_out=silver.count_run(run_id), quality_summary=verdict_of(found))
        except Exception as exc:
            ledger.finish(run_id, "failed", error=str(exc))
            raise
    return handle


def _by_file(lake: Lake, videos: bool, columns: Sequence[str], handle: Callable[[DataFrame, int], None]):
    """Read a batch's files by header; columns of the source's layout that no file has are null."""
    def read(batch: DataFrame, batch_id: int) -> None:
        paths = _of_kind(batch, videos)
        if paths:
            rows = files.read_csv(lake.spark, paths)
            low = {c.lower() for c in rows.columns}
            handle(rows.withColumns({c: F.lit(None).cast("string") for c in columns if c.lower() not in low}), batch_id)
    return read


def _new_files_only(lake: Lake, source: str, context: str, stream: str, read: Callable[[DataFrame, int], None]):
    """Hand on only files whose bytes no run, of a stream or a batch job, has loaded; finish runs that broke off with them."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        paths, run_id, seq = _of_kind(batch, False), f"{stream}_{source}_{batch_id}", now_micros()
        if not paths:
            return
        resume_runs(lake, take_files(lake, paths, run_id, seq, context), context)
        log = lake.files(context)
        new = [r["file_path"] for r in log.files_of(run_id).select("file_path").collect()]  # a trigger's paths are few
        if new:
            read(batch.sparkSession.createDataFrame([(p,) for p in new], "path string"), batch_id)
        log.reach(run_id, "done", seq)
    return handle


def _when_settled(spark: SparkSession, quiet: float, handle: Callable[[DataFrame, int], None]):
    """Hand on a batch of paths when none of its files grows any more. A batch that waited in vain fails and is tried again."""
    def wait(batch: DataFrame, batch_id: int) -> None:
        if quiet > 0:
            files.wait_until_settled(spark, [r["path"] for r in batch.select("path").collect()], quiet)  # a trigger's paths are few
        handle(batch, batch_id)
    return wait


def stream_posts(lake: Lake, inbox: str, source: str, checkpoint: str, once: bool = True, every: str = RESCAN,
                 files_per_trigger: int | None = None, archive: str | None = None,
                 context: str = "posts", quiet: float = 0) -> StreamingQuery:
    """Comment files of one source into raw and silver. With ``files_per_trigger=1`` a file that grows delays no other of its batch."""
    paths = inbox_stream(lake.spark, inbox, source, files_per_trigger, archive)
    stream = f"inbox-{stream_id(lake.spark, checkpoint)}"
    columns = [] if source == "external" else schemas.COMMENT_CSV[source]
    read = _by_file(lake, False, columns, post_batch(lake, source, context, stream))
    handle = _when_settled(lake.spark, quiet, _new_files_only(lake, source, context, stream, read))
    return _start(paths.writeStream.foreachBatch(handle), checkpoint, once, every)


def unique_rows(rows: DataFrame, keys: Sequence[str], arrived: str, within: str) -> DataFrame:
    """A stream without rows whose keys came before within a span of time. The state holds the keys of that span only; repeats
    of older ones are for the table to find."""
    return rows.withWatermark(arrived, within).dropDuplicatesWithinWatermark(list(keys))


def stream_rows(lake: Lake, rows: DataFrame, source: str, checkpoint: str, keys: Sequence[str], arrived: str, within: str = "2 days",
                once: bool = True, every: str = RESCAN, context: str = "posts") -> StreamingQuery:
    """A stream of rows in a source's layout, with a time of arrival, into raw and silver.

    Repeats that follow each other closely never reach a batch; those that come after ``within`` are dropped by the ids of silver.
    """
    handle = post_batch(lake, source, context, f"rows-{stream_id(rows.sparkSession, checkpoint)}")
    if "file_path" not in rows.columns:
        rows = rows.withColumn("file_path", F.lit(None).cast("string"))
    return _start(unique_rows(rows, keys, arrived, within).drop(arrived).writeStream.foreachBatch(handle), checkpoint, once, every)


def stream_videos(lake: Lake, inbox: str, source: str, checkpoint: str, once: bool = True, every: str = RESCAN,
                  files_per_trigger: int | None = None, quiet: float = 0) -> StreamingQuery:
    """Video files (``*_videos.csv``) of one source into its video table; other files are left to ``stream_posts``."""
    own = stream_id(lake.spark, checkpoint)

    def handle(rows: DataFrame, batch_id: int) -> None:
        run_id, seq = f"videos-{own}_{source}_{batch_id}", now_micros()
        good, bad = media.VIDEO_MAPPERS[source](rows, run_id)
        lake.quarantine().write(quarantine_rows(bad, run_id, f"{source}_videos"), seq, run_id)
        lake.videos(source).write(dedupe(good, ["video_id"], ["file_path", "file_order"]), seq, run_id)

    paths = inbox_stream(lake.spark, inbox, source, files_per_trigger)
    read = _when_settled(lake.spark, quiet, _by_file(lake, True, schemas.VIDEO_CSV[source], handle))
    return _start(paths.writeStream.foreachBatch(read), checkpoint, once, every)


def stream_upsert(rows: DataFrame, table: VersionedTable, checkpoint: str, order_by: list[str], once: bool = True,
                  every: str = RESCAN) -> StreamingQuery:
    """Any stream of keyed rows into a table, the last row of a key winning; the time of a batch's first try orders it."""
    own = stream_id(rows.sparkSession, checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.write(dedupe(batch, table.keys, order_by), now_micros(), f"stream-{own}-{batch_id}")
    return _start(rows.writeStream.foreachBatch(handle), checkpoint, once, every)
