"""Which ids a large table holds, clustered so that a small batch reads the pages of its own ids and no others.

Ids are stored in the order of a hash, in Parquet pages of PAGE rows with their least and greatest hash. A batch of up to
LOOKUP ids asks for its hashes by value: the scan skips all pages that hold none of them. A larger batch is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agoralake import schemas
from agoralake.operators.dedupe import dedupe
from agoralake.sources.tables import VersionedTable

PAGE = 256
LOOKUP = 1000
SCHEMA = schemas.T.StructType([schemas.T.StructField("id", schemas.S), schemas.T.StructField("h", schemas.L)])


def id_hash(c: Column | str = "id") -> Column:
    return F.xxhash64(c)


def _clustered(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange("h").sortWithinPartitions("h")


class IdIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = VersionedTable(spark, path, SCHEMA, ["id"], arrange=_clustered, options={
            "parquet.page.row.count.limit": str(PAGE), "parquet.page.size.row.check.min": "32", "parquet.page.size.row.check.max": str(PAGE)})

    def add(self, rows: DataFrame, run_id: str, seq: int) -> None:
        """The ids of a run's rows; a repeated run replaces what it added."""
        self.table.write(dedupe(rows.select("id", id_hash().alias("h")), ["id"], ["h"]), seq, run_id)

    def known(self, rows: DataFrame, but_run: str | None = None) -> DataFrame:
        """``id`` of those ids of ``rows`` that any run but one has added."""
        asked = [r["h"] for r in rows.select(id_hash().alias("h")).distinct().limit(LOOKUP + 1).collect()]
        held = self.table.history() if but_run is None else self.table.without_run(but_run)
        if len(asked) <= LOOKUP:
            # Spark hands value lists up to this length to Parquet; longer ones only as a range.
            name = "spark.sql.parquet.pushdown.inFilterThreshold"
            if int(self.spark.conf.get(name)) < LOOKUP:
                self.spark.conf.set(name, str(LOOKUP))
            held = held.where(F.col("h").isin(asked))
        return held.select("id").join(rows.select("id").distinct(), "id", "left_semi").distinct()
