"""De-duplication, alignment, set differences and their plans."""

import random

from pyspark.sql import functions as F

from etalage.operators import rows as R

from comparison import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_row_per_key_is_chosen_before_the_shuffle(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 50)}", i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, i int").repartition(6)
    last = R.keep_last(df, ["k"], ["i"])
    want = {}
    for k, i in data:
        want[k] = max(i, want.get(k, -1))
    assert dict(rows(last)) == want
    assert "WindowGroupLimit" in plan(last) and plan(last).index("Final") < plan(last).index("Partial")


def test_latest_date_with_missing_dates_first(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "2024-01-01", 2), ("b", "2024-01-01", 2), ("b", "2024-01-01", 1)],
                               "k string, d string, t int")
    assert rows(R.dedup_latest(df, ["k"], "d", ["t"])) == [("a", None, 1), ("b", "2024-01-01", 1)]


def test_filters(spark):
    df = spark.createDataFrame([("1", 500.0, 1, " Annulé "), ("", 600.0, 1, "Validé"), (None, 700.0, 1, "Validé"),
                                ("4", 499.0, 0, None), ("5", 5_000_000.0, 2, "Validé")],
                               "id string, m double, q int, s string")
    assert rows(R.missing_id_filter(df, "id"), "id") == [("1",), ("4",), ("5",)]
    assert rows(R.amount_range(df, "m"), "m") == [(500.0,), (5000000.0,), (600.0,), (700.0,)]
    assert R.positive_quantity(df, "q").count() == 4
    assert R.status_is_not(df, "s", "Annulé").count() == 3  # a missing status goes too
    assert R.status_is(df, "s", "Annulé").count() == 1
    assert R.accepted_set(df, "s", ["Validé"]).count() == 3


def test_union_aligns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, i int")
    assert rows(R.union_aligned(a, b), "i", "a", "b") == [(1, "x", None), (2, None, "y")]


def test_key_differences(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "k int")
    assert rows(R.key_set_difference(a, b, "k")) == [(1,), (None,)]
    assert R.broken_references(a, b, "k").count() == 2  # a null key passes


def test_duplicates(spark):
    data = [("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1), ("b", 1)]
    df = spark.createDataFrame(data, "k string, v int")
    assert tuple(R.duplicate_count(df, ["k"]).first()) == (6, 3)
    assert R.duplicate_rows(df).first()[0] == 2
    assert R.duplicate_rows(df.limit(0)).first()[0] == 0


def test_slimming_and_top_k(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, "c")], "x int, y string")
    assert R.column_slimming(df, ["y", "z"], {"y": "w"}).columns == ["w"]
    best = R.top_k(df, 2, F.desc("x"))
    assert [r["x"] for r in best.collect()] == [3, 2]
    assert "TakeOrderedAndProject" in plan(best)
    assert [r["x"] for r in R.sort_output(df, F.asc("x")).collect()] == [1, 2, 3]
