import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "8g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def column(spark):
    """Evaluate a column expression over a list of texts."""
    from pyspark.sql import functions as F

    def evaluate(expression, values, type_="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {type_}")
        rows = df.select("i", expression(F.col("c")).alias("r")).collect()
        return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]

    return evaluate
