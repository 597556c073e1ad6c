"""Global ranks, tiles and quantiles: the distributed path equals the plain one on hostile data."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from etalage.operators import quantiles as QT, ranking as R, rows as RW
from etalage.operators.aggregates import QUINTILES

from comparison import rows


def table(spark, n, seed):
    """A third of all rows share one value."""
    rng = random.Random(seed)
    data = [(i, 7 if rng.random() < 0.34 else rng.randint(0, n // 4)) for i in range(n)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k long, v long").repartition(5)


@pytest.fixture(params=[1, 3, 8])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_row_number_and_rank(spark, partitions):
    df = table(spark, 400, partitions)
    order = Window.orderBy(F.desc("v"), "k")
    want = df.withColumn("r", F.row_number().over(order).cast("long"))
    assert rows(R.global_row_number(df, [F.desc("v"), F.asc("k")], "r")) == rows(want)
    want = df.withColumn("r", F.rank().over(Window.orderBy(F.desc("v"))).cast("long"))
    assert rows(R.global_rank(df, "v", "k", "r")) == rows(want)


def test_several_ranks_and_nulls(spark, partitions):
    data = [(i, None if i % 11 == 0 else i % 7, i % 3) for i in range(120)]
    df = spark.createDataFrame(data, "k long, a long, b long").repartition(4)
    ranks = {"ra": F.rank().over(Window.orderBy(F.desc_nulls_last("a"))).cast("long"),
             "rb": F.rank().over(Window.orderBy(F.desc("b"))).cast("long")}
    assert rows(R.global_ranks(df, {"ra": "a", "rb": "b"})) == rows(df.withColumns(ranks))
    up = df.withColumn("ra", F.rank().over(Window.orderBy(F.asc_nulls_last("a"))).cast("long"))
    assert rows(R.global_rank(df, "a", "k", "ra", ascending=True)) == rows(up)


def test_running_counts(spark, partitions):
    df = table(spark, 300, partitions)
    n = {r["v"]: r["count"] for r in df.groupBy("v").count().collect()}
    got = rows(R.running_counts(df, F.col("v"), F.asc))
    assert got == sorted(((v, n[v], sum(n[w] for w in n if w < v)) for v in n), key=lambda t: tuple((False, str(x)) for x in t))


def test_columns_are_written_for_several_reads(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k int, t string, v double")
    narrow = RW.read_often(df, ["v", "k", "other", "v"])
    assert narrow.columns == ["v", "k"] and "Scan parquet" in narrow._jdf.queryExecution().executedPlan().toString()
    assert RW.read_often(df, ["t"], written=True).columns == ["t"]


@pytest.mark.parametrize("n", [3, 5, 402])
def test_tiles(spark, n):
    df = table(spark, n, n)
    want = df.withColumn("t", F.ntile(5).over(Window.orderBy("v", "k")))
    edges = R.ntile_edges(df, 5, "v", "k").scalar()
    got = df.withColumn("t", R.ntile_of(F.col("v"), F.col("k"), edges, 5))
    assert rows(got) == rows(want)
    sizes = [r["count"] for r in want.groupBy("t").count().collect()]
    assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("n", [1, 2, 5, 1001])
def test_quantiles_interpolate_linearly(spark, partitions, n):
    df = table(spark, n, n + partitions)
    probs = [0.0, 0.1, 0.25, 0.5, *QUINTILES, 1.0]
    values = [r["v"] for r in df.collect()]
    got = QT.exact_quantiles(df, "v", probs).first()["q"]
    assert np.allclose(got, np.quantile(values, probs), rtol=1e-12)


def test_quantiles_without_rows_and_with_nulls(spark):
    empty = spark.createDataFrame([], "v double")
    assert QT.exact_quantiles(empty, "v", [0.5]).first()["q"] == []
    some = spark.createDataFrame([(None,), (1.0,), (3.0,)], "v double")
    assert QT.exact_quantiles(some, "v", [0.5]).first()["q"] == [2.0]
    marked = QT.iqr_outliers(empty, "v")
    assert marked.count() == 0


def test_sketch_returns_observed_values(spark):
    df = table(spark, 500, 1)
    got = QT.approx_quantiles(df, "v", [0.25, 0.75]).first()["q"]
    assert set(got) <= {float(r["v"]) for r in df.collect()}


def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(float(x),) for x in range(1, 11)] + [(None,)], "v double")
    edges = QT.exact_quantiles(df, "v", QUINTILES).scalar()
    up = {r["v"]: r["s"] for r in df.withColumn("s", QT.quantile_score(F.col("v"), edges, 5, True)).collect()}
    down = {r["v"]: r["s"] for r in df.withColumn("s", QT.quantile_score(F.col("v"), edges, 5, False)).collect()}
    assert [up[float(x)] for x in range(1, 11)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert all(up[v] + down[v] == 6 for v in up if v is not None)
    assert up[None] == down[None] == 3


def test_fixed_bins(column):
    got = column(lambda c: QT.fixed_bins(c, [0, 90, 365], ["a", "b", "c"]), [0, 1, 90, 91, 365, 366, None, -5], "int")
    assert got == [None, "a", "a", "b", "b", "c", None, None]


def test_shares_add_up(spark):
    df = spark.createDataFrame([(i, Decimal(i) / 3) for i in range(1, 40)], "k int, v decimal(15,2)")
    total = R.share_of_total(df, "v", "p").agg(F.sum("p")).first()[0]
    assert abs(float(total) - 100) < 0.2
