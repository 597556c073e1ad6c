"""Quality reports, checks and declared tests."""

import datetime as dt

from pyspark.sql import functions as F

from etalage.functions.rules import Rule
from etalage.operators import column_tests as CT, quality as Q

from comparison import rows


def values(check):
    return {r["metric"]: (r["value"], r["status"]) for r in check.collect()}


def test_report_scores_completeness_and_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "k string, v int")
    rule = Rule("v", F.col("v") > 1, F.concat(F.lit("v="), F.col("v").cast("string")))
    summary, columns = Q.quality_report(df, "demo", [rule])
    assert tuple(summary.first()) == ("demo", 4, 2, 2, 1, 2, 75.0)
    assert rows(columns) == [(4, "k", 1, 75.0), (4, "v", 1, 75.0)]
    assert rows(Q.error_details(df, [rule])) == [("v",), ("v=2",)]  # a null condition is broken
    assert tuple(Q.quality_report(df.limit(0), "vide")[0].first())[1:] == (0, 2, 0, 0, 0, 50.0)


def test_details_hold_all_messages_or_the_first(spark):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    always = [Rule(str(i), F.lit(True), F.lit(str(i))) for i in range(5)]
    assert Q.error_details(df, always).count() == 10
    assert Q.error_details(df, always, per_row=3).count() == 6


def test_completeness(spark):
    df = spark.createDataFrame([(f"C{i}", None if i % 10 == 0 else "x") for i in range(20)], "client_id string, email string")
    assert values(Q.completeness_check(df)) == {
        "client_id": (100.0, "OK"), "nom": (0.0, "ALERTE"), "email": (90.0, "ALERTE"), "ville": (0.0, "ALERTE")}


def test_duplicates(spark):
    df = spark.createDataFrame([(f"T{i}",) for i in range(500)] + [("T1",), ("T2",)], "transaction_id string")
    assert values(Q.duplicate_check(df)) == {"nb_doublons": (2.0, "OK"), "taux_doublons": (0.4, "OK")}


def test_anomalies(spark):
    amounts = [float(x) for x in range(100, 198)] + [-1.0, 9999999.0, None]
    got = values(Q.amount_anomalies(spark.createDataFrame([(x,) for x in amounts], "montant_total_xaf double")))
    assert got == {"montant_median": (148.5, "OK"), "outliers_iqr": (2.0, "OK"), "outliers_zscore": (1.0, "OK"),
                   "montants_invalides": (1.0, "ALERTE")}


def test_references(spark):
    tx = spark.createDataFrame([("C1", "P1"), ("C2", "P1"), ("C2", "P1"), ("C9", "P1")], "client_id string, produit_id string")
    clients = spark.createDataFrame([("C1",), ("C2",), ("C2",)], "client_id string")
    products = spark.createDataFrame([("P1",)], "produit_id string")
    got = values(Q.referential_check(tx, {"client_id": clients, "produit_id": products}))
    assert got == {"client_id_distincts": (3.0, "OK"), "client_id_orphelins": (1.0, "ALERTE"),
                   "client_id_orphelins_pct": (33.3, "ALERTE"), "produit_id_distincts": (1.0, "OK"),
                   "produit_id_orphelins": (0.0, "OK"), "produit_id_orphelins_pct": (0.0, "OK"), "coherence_ok": (0.0, "ALERTE")}
    assert rows(Q.orphan_keys(tx, {"client_id": clients, "produit_id": products})) == [("client_id", "C9")]


def test_volume_and_nulls(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 1), -1), (dt.date(2030, 1, 2), None)], "date_transaction date, m int")
    assert values(Q.daily_volume_check(df, "2024-01-02")) == {"nb_transactions_du_jour": (2.0, "OK")}
    assert values(Q.daily_volume_check(df, "2024-02-02")) == {"nb_transactions_du_jour": (0.0, "ALERTE")}
    assert rows(Q.daily_volume(df, minimum=2), "nb_lignes", "statut") == [(1, "ALERTE"), (2, "OK")]
    got = values(Q.null_rate_alert(df, amounts=["m"], date_bounds={"date_transaction": ("2024-01-01", "2024-12-31")}))
    assert got == {"nullite_date_transaction": (0.0, "OK"), "nullite_m": (33.33, "ALERTE"),
                   "non_positifs_m": (1.0, "ALERTE"), "hors_periode_date_transaction": (1.0, "ALERTE")}


def test_stockout_and_summary(spark):
    stock = spark.createDataFrame([(True,), (False,), (False,), (False,)], "alerte_rupture boolean")
    check = Q.stockout_rate(stock)
    assert values(check) == {"taux_rupture": (25.0, "ALERTE")}
    assert Q.quality_summary(check, check).count() == 2


def test_column_tests(spark):
    parent = spark.createDataFrame([("a",)], "k string")
    child = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y"), ("b", None, None), (None, 2, "z")], "k string, n int, c string")
    tests = [CT.ColumnTest("child", "k", "not_null"), CT.ColumnTest("child", "k", "unique"),
             CT.ColumnTest("child", "c", "accepted_values", ("x", "y")), CT.ColumnTest("child", "n", "positive"),
             CT.ColumnTest("child", "k", "relationships", to="parent"),
             CT.ColumnTest("child", "k", "unique", key=("k", "n")), CT.ColumnTest("absent", "k", "unique")]
    got = rows(CT.run_column_tests({"child": child, "parent": parent}, tests), "column", "test", "failures", "status")
    assert got == [("c", "accepted_values", 1, "ALERTE"), ("k", "not_null", 1, "ALERTE"), ("k", "relationships", 1, "ALERTE"),
                   ("k", "unique", 1, "ALERTE"), ("k", "unique", None, "NON EXÉCUTÉ"), ("k+n", "unique", 0, "OK"), ("n", "positive", 1, "ALERTE")]


def test_the_declared_tests_are_complete():
    kinds = [t.kind for t in CT.MODEL_TESTS]
    assert len(kinds) == 38
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values"), kinds.count("relationships")) == (23, 6, 8, 1)
