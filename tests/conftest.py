import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from agoralake.session import build_session
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column over literal values: one(lambda c: F.lower(c), "A", "B") -> ["a", "b"]."""
    def run(expression, *values, kind="string"):
        from pyspark.sql import functions as F
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        rows = df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()
        return [r["x"] for r in rows]
    return run
