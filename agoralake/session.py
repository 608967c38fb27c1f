"""Session settings the package relies on, and the shared working folder for intermediate tables."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plans. Sizes (executors, memory, shuffle partitions) stay with the cluster.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller already owns."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "agoralake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a cluster falls back on its warehouse folder, and a local master (tests, laptops) on a folder of its
    own that goes when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    own = tempfile.mkdtemp(prefix="agoralake-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


_MADE: list[str] = []  # work paths of this process


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    _MADE.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}")
    return _MADE[-1]


def clear_work(spark: SparkSession) -> int:
    """Delete the work folders this process has made, once nothing that reads them is still to run. Returns how many there were."""
    n = len(_MADE)
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Each job's shuffle files go when it ends; what later steps read is stored."""
    before = spark.conf.get(FREED)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def freeing(job: Callable) -> Callable:
    """A job over a lake whose steps leave no shuffle files behind."""
    @functools.wraps(job)
    def run(lake, *args, **options):
        with shuffles_freed(lake.spark):
            return job(lake, *args, **options)

    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps read to the shared folder and read it back.

    Unlike a cache it survives the loss of executors, and each later step starts from stored columns.
    """
    spark = df.sparkSession
    path = new_work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
