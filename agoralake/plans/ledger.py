"""The run ledger: append-only events, the current state of a run resolved when read."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralake import schemas
from agoralake.sources.tables import VersionedTable

STATUSES = ("running", "success", "failed", "quality_failed")


def new_run_id() -> str:
    return str(uuid.uuid4())


def now_micros() -> int:
    return int(dt.datetime.now(dt.timezone.utc).timestamp() * 1_000_000)


def _time(micros: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(micros / 1_000_000, dt.timezone.utc)


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = VersionedTable(spark, path, schemas.RUN, ["run_id"])

    def _add(self, seq: int, run_id: str, **fields) -> None:
        row = tuple({"run_id": run_id, **fields}.get(f.name) for f in schemas.RUN.fields)
        self.table.write(self.spark.createDataFrame([row], schemas.RUN), seq, f"{fields['status']}-{run_id}")

    def start(self, flow_name: str, rows_in: int | None = None, run_id: str | None = None) -> str:
        run_id = run_id or new_run_id()
        seq = now_micros()
        self._add(seq, run_id, flow_name=flow_name, status="running", started_at=_time(seq), rows_in=rows_in)
        return run_id

    def finish(self, run_id: str, status: str, rows_out: int | None = None, quality_summary: dict | None = None,
               error: str | None = None) -> None:
        if status not in STATUSES:
            raise ValueError(f"unknown status {status}; one of {STATUSES}")
        seq = now_micros()
        summary = None if quality_summary is None else {k: str(v) for k, v in quality_summary.items()}
        self._add(seq, run_id, status=status, finished_at=_time(seq), rows_out=rows_out, quality_summary=summary,
                  error=error)

    def runs(self) -> DataFrame:
        return current_runs(self.table.history())


def current_runs(events: DataFrame) -> DataFrame:
    """One row per run: what was said first about its start and last about its end."""
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("version"))).alias(c)
    return events.groupBy("run_id").agg(
        newest("flow_name"), F.max_by("status", "version").alias("status"), F.min("started_at").alias("started_at"),
        newest("finished_at"), newest("rows_in"), newest("rows_out"), newest("quality_summary"), newest("error"),
    ).select(*[f.name for f in schemas.RUN.fields])
