"""Layer tables on plain Parquet: each run writes a folder of its own, keys are resolved when read.

A write never touches finished data: a repeated run writes a new attempt, which counts from the moment it is complete, and
its cost follows the batch and not the table. ``compact`` folds all folders into a new one that lists what it covers, and
keeps with every row the version it came from, so runs can still be told apart.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from agoralake.operators.dedupe import dedupe
from agoralake.sources.files import hadoop_path, read_small_text, write_small_text

_FULL, _COVERS, _ORIGIN = ".full", "_COVERS", "_origin"


def _base(version: str) -> str:
    """A version without its attempt."""
    return version.rsplit("~", 1)[0]


def _run_of(version: str) -> str:
    return _base(version).split("-", 1)[1]


class VersionedTable:
    """``arrange`` puts rows in the order they are stored in, ``options`` are passed to the Parquet writer, which compresses by
    Zstandard else: texts take two thirds of what Spark's usual compression leaves of them."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                 partition_by: Sequence[str] = (), arrange: Callable[[DataFrame], DataFrame] | None = None,
                 options: dict[str, str] | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.partition_by = list(keys), list(partition_by)
        self.arrange, self.options = arrange or (lambda df: df), {"compression": "zstd", **(options or {})}

    @staticmethod
    def version(seq: int, run_id: str) -> str:
        return f"{seq:020d}-{run_id}"

    def _folder(self, version: str) -> str:
        return f"{self.path}/version={version}"

    def _found(self, mark: str) -> list[str]:
        """Versions that hold a mark; one listing whatever their number."""
        fs, pattern = hadoop_path(self.spark, f"{self.path}/version=*/{mark}")
        return sorted(f.getPath().getParent().getName().split("=", 1)[1] for f in (fs.globStatus(pattern) or []))

    def _state(self) -> tuple[str | None, list[str], list[str]]:
        """The newest full version, the finished versions it does not cover, and all that are covered."""
        last = {_base(v): v for v in self._found("_SUCCESS") if not _base(v).endswith(_FULL)}  # the last attempt of each
        full = max(self._found(_COVERS), key=lambda v: v.rsplit("~", 1)[1], default=None)
        covered = read_small_text(self.spark, f"{self._folder(full)}/{_COVERS}").split("\n") if full else []
        known = set(covered)
        return full, sorted(v for v in last.values() if v not in known), covered

    def versions(self) -> list[str]:
        """The folders the table is read from, in order; a full one comes first."""
        full, rest, _ = self._state()
        return ([full] if full else []) + rest

    def _rows(self, wanted=lambda run: True) -> DataFrame:
        """Rows and their ``version``. ``wanted`` chooses runs. Repeated runs hide their rows in the full version."""
        full, rest, covered = self._state()
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.StringType())])
        read = self.spark.read.option("basePath", self.path)
        own = [v for v in rest if wanted(_run_of(v))]
        out = read.schema(schema).parquet(*[self._folder(v) for v in own]) if own else self.spark.createDataFrame([], schema)
        if full:
            gone = {_base(v) for v in rest}
            kept = [v for v in covered if v and _base(v) not in gone and wanted(_run_of(v))]
            inner = T.StructType([*self.schema.fields, T.StructField(_ORIGIN, T.StringType())])
            rows = read.schema(inner).parquet(self._folder(full)).withColumn("version", F.col(_ORIGIN)).drop(_ORIGIN)
            if len(kept) < len(covered):
                rows = rows.where(F.col("version").isin(kept))
            out = out.unionByName(rows)
        return out

    def _write(self, df: DataFrame, version: str, extra: Sequence[str] = (), arranged: bool = False) -> str:
        name = f"{version}~{time.time_ns() // 1000:020d}"
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        rows = df.select(*columns, *extra)
        (rows if arranged else self.arrange(rows)).write.options(**self.options).mode("errorifexists").partitionBy(
            *self.partition_by).parquet(self._folder(name))
        return name

    def write(self, df: DataFrame, seq: int, run_id: str, arranged: bool = False) -> None:
        """Write one batch. ``seq`` orders batches; rows of a batch must already be unique by key.

        A run that has a finished version keeps its place, so repeating the run replaces what it wrote before. With ``arranged``
        rows are written as they stand.
        """
        _, rest, covered = self._state()
        before = [v for v in [*covered, *rest] if v and _run_of(v) == run_id]
        self._write(df, _base(before[-1]) if before else self.version(seq, run_id), arranged=arranged)

    def history(self) -> DataFrame:
        return self._rows()

    def run(self, run_id: str) -> DataFrame:
        """Rows of one run; only its folder is read, or after compaction its rows in the full version."""
        return self._rows(lambda r: r == run_id).drop("version")

    def without_run(self, run_id: str) -> DataFrame:
        """The table as it was without one run, so that a repeated run does not see its own rows."""
        return self._rows(lambda r: r != run_id)

    def count_run(self, run_id: str) -> int:
        """Answered from the Parquet footers."""
        return self.run(run_id).count()

    def runs(self) -> list[str]:
        """Runs in the order of their versions, compacted ones included."""
        _, rest, covered = self._state()
        return list(dict.fromkeys(_run_of(v) for v in sorted([v for v in covered if v] + rest)))

    def latest(self, wanted: Callable[[str], bool] = lambda run: True) -> DataFrame:
        """One row per key, the newest version winning; ``wanted`` chooses runs.

        A filter on key columns passes below the choice of the newest row, so where partition columns are part of the key it
        reaches the scan and prunes folders.
        """
        rows = self._rows(wanted)
        return (rows if len(self.versions()) < 2 else dedupe(rows, self.keys, ["version"])).drop("version")

    def has_run(self, run_id: str) -> bool:
        """Whether a run has a finished version."""
        return run_id in self.runs()

    def compact_when_due(self, seq: int, loose: int = 16, most: int = 512) -> bool:
        """Fold the folders once many are loose and they hold a quarter of what the full version holds: as each fold grows the
        full version by a fixed share, a row is rewritten a number of times that does not follow the number of batches."""
        full, rest, _ = self._state()
        if len(rest) < loose:
            return False
        def size(version: str) -> int:
            fs, path = hadoop_path(self.spark, self._folder(version))
            return fs.getContentSummary(path).getLength()
        if full and len(rest) < most and 4 * sum(map(size, rest)) < size(full):
            return False
        self.compact(seq)
        return True

    def compact(self, seq: int) -> None:
        """Write the newest row of every key as a new full version. It counts once its list of covered versions is there;
        what came meanwhile is not on the list and is read beside it."""
        _, rest, covered = self._state()
        if not rest:
            return
        gone = {_base(v) for v in rest}
        rows = dedupe(self._rows(), self.keys, ["version"]).withColumn(_ORIGIN, F.col("version"))
        name = self._write(rows, self.version(seq, f"compact-{uuid.uuid4().hex[:12]}{_FULL}"), [_ORIGIN])
        listed = [*[v for v in covered if v and _base(v) not in gone], *rest]
        write_small_text(self.spark, f"{self._folder(name)}/{_COVERS}", "\n".join(listed))

    def vacuum(self) -> None:
        """Delete folders that no reader that starts now would use, those of broken writes among them. Call it when earlier
        readers and writers are done."""
        used = set(self.versions())
        fs, pattern = hadoop_path(self.spark, f"{self.path}/version=*")  # folders of broken writes have no mark
        for f in fs.globStatus(pattern) or []:
            if f.getPath().getName().split("=", 1)[1] not in used:
                fs.delete(f.getPath(), True)


def append_jsonl(posts: DataFrame, path: str, ingest_date: str) -> None:
    """Append bronze posts as JSON lines in folders by source and day."""
    (posts.withColumn("ingest_date", F.lit(ingest_date)).write.mode("append")
     .partitionBy("source", "ingest_date").json(path))


def source_counts(posts: DataFrame) -> DataFrame:
    return posts.groupBy("source").agg(F.count(F.lit(1)).alias("registros"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export; arrays are shown as text."""
    shown = [
        F.array_join(F.col(f.name), ", ").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*shown).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def merged_checkpoint(existing: DataFrame, new: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Scored posts so far plus new ones; on equal text and time the last row wins, new ones counting as later."""
    both = existing.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    return dedupe(both, ["texto_usuario_norm", "fecha"], ["_age", *order_by]).drop("_age")


def refresh_daily(view: DataFrame, path: str) -> None:
    """Materialise a view as a table that ``read_daily`` loads instead of computing it.

    The new state is written aside; the one before it stays for readers that have begun, older ones are deleted.
    """
    view.write.parquet(f"{path}/state={time.time_ns() // 1000:020d}")
    fs, pattern = hadoop_path(view.sparkSession, f"{path}/state=*/_SUCCESS")
    for f in sorted(fs.globStatus(pattern), key=lambda f: f.getPath().toString())[:-2]:
        fs.delete(f.getPath().getParent(), True)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished state of a materialised view."""
    fs, pattern = hadoop_path(spark, f"{path}/state=*/_SUCCESS")
    states = sorted(f.getPath().getParent().toString() for f in (fs.globStatus(pattern) or []))
    if not states:
        raise FileNotFoundError(path)
    return spark.read.parquet(states[-1])
