"""Which stage every input file has reached, so that a run takes up what a broken one left behind.

A file is known by the digest of its bytes. A run first says which files it has seen, then which stage they have reached; a
later run over the same files finds runs that stopped between two stages and finishes them under their own name. One run works
on a context at a time: what another run has begun and not ended counts as broken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agoralake import schemas
from agoralake.sources.tables import VersionedTable

#: In the order in which a file passes them. ``seen`` files have not been stored; ``done`` ones need no more work.
STAGES = ("seen", "bronze", "silver", "gate", "gold", "done")
SCHEMA = schemas.T.StructType([schemas.T.StructField(c, schemas.S) for c in ("source_sha256", "file_path", "run_id", "goal", "stage")])


def rank(stage: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, STAGES)), stage)


class FileLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = VersionedTable(spark, path, SCHEMA, ["source_sha256", "run_id", "stage"])

    def see(self, files: DataFrame, run_id: str, goal: str, seq: int) -> None:
        """A run takes (file_path, source_sha256); ``goal`` is the last layer it wants."""
        self.table.write(files.select("source_sha256", "file_path", F.lit(run_id).alias("run_id"), F.lit(goal).alias("goal"),
                                      F.lit("seen").alias("stage")), seq, f"seen-{run_id}")

    def files_of(self, run_id: str) -> DataFrame:
        return self.table.run(f"seen-{run_id}")

    def reach(self, run_id: str, stage: str, seq: int) -> None:
        """All files of a run have reached a stage."""
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage}; one of {STAGES}")
        self.table.write(self.files_of(run_id).withColumn("stage", F.lit(stage)), seq, f"{stage}-{run_id}")

    def state(self, files: DataFrame | None = None, but_run: str | None = None) -> DataFrame:
        """(source_sha256, run_id, goal, stage): of all runs that took a file the one that got furthest with it.

        With ``files`` only of those: their digests go to the log, which may be far larger. ``but_run`` is left out.
        """
        rows = self.table.history() if but_run is None else self.table.history().where(F.col("run_id") != but_run)
        if files is not None:
            rows = rows.join(files.select("source_sha256").distinct(), "source_sha256", "left_semi")
        best = F.max_by(F.struct("run_id", "goal", "stage"), F.struct(rank(F.col("stage")), F.col("version"))).alias("s")
        return rows.groupBy("source_sha256").agg(best).select("source_sha256", "s.run_id", "s.goal", "s.stage")
