import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small():
    """Folder of the smallest tables."""
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def documents(spark, small):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


@pytest.fixture
def docs(spark):
    """A documents table of (id, text) pairs, with nulls elsewhere and columns whose names operators use themselves."""
    def make(rows, lang="en", source="s"):
        df = spark.createDataFrame([(i, t, lang, source, None) for i, t in rows], DOCS)
        for name in ("drop", "features", "quality", "simhash", "matches", "tokens", "shard", "before", "row", "keep_id",
                     "repeat_spans", "n_words"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return make


LONG = "wort " * 30_000
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (4, "a"), (4, "b"), (None, "a"), (None, None), (5, LONG), (6, LONG),
       (7, "\x00ö\u0085\u2028 é  ß"), (8, "A\r\nB\n\n"), (9, "x" * 5000), (10, "🙂 " * 900), (11, "one two three four")]
