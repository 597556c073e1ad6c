"""What holds for tables of any size: plans, limits of numbers, loads that lose nothing."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from etalage.functions import numbers, rules
from etalage.operators import aggregates as A, column_tests as CT, marts as M, quality as Q, quantiles as QT, ranking as R
from etalage.operators import transactions as X
from etalage.plans import daily
from etalage.sinks import files as SF, warehouse as W
from etalage.sources import files
from etalage.storage import materialise, scratch

from comparison import rows


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def facts(spark):
    tx = [(f"T{i}", dt.date(2024, 1 + i % 3, 1 + i % 28), f"C{i % 7}", f"P{i % 5}", f"M{i % 3}", i % 4, Decimal(1000 + i), Decimal(100),
           "En ligne", "Virement") for i in range(60)]
    return spark.createDataFrame(tx, "transaction_id string, date_transaction date, client_id string, produit_id string, "
                                     "magasin_id string, quantite long, montant_total_xaf decimal(15,2), prix_unitaire_xaf decimal(15,2), "
                                     "canal_vente string, mode_paiement string").withColumn("est_vente_en_ligne", F.lit(True))


def test_no_window_over_all_rows_and_no_nested_loop(spark):
    """The windows without partition run over one row per range partition, after an aggregation."""
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    for out in (R.global_rank(df, "v", "k"), R.global_row_number(df, [F.asc("v"), F.asc("k")]), QT.iqr_outliers(df, "v"),
                QT.exact_quantiles(df, "v", [0.5])):
        shown = out._jdf.queryExecution().optimizedPlan().toString()
        assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
        for line in shown.splitlines():
            assert "Window [row_number()" not in line and "Window [rank(" not in line


def test_percentages_of_any_size(spark):
    df = spark.createDataFrame([(Decimal("1e17"), Decimal("3e17")), (Decimal("1e12"), Decimal("1.00")), (Decimal("-1"), Decimal("3")),
                                (Decimal("1"), Decimal("0")), (Decimal("0.05"), Decimal("1000"))], "a decimal(28,2), b decimal(28,2)")
    got = [r["p"] for r in df.select(numbers.percent_of(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == [Decimal("33.33"), Decimal("1e14"), Decimal("-33.33"), None, Decimal("0.01")]
    shares = R.share_of_total(spark.createDataFrame([(Decimal("5e16"),), (Decimal("5e16"),)], "v decimal(28,2)"), "v", "p")
    assert [r["p"] for r in shares.collect()] == [Decimal("50.00")] * 2


def test_integers_beyond_32_bits_and_times_of_day(spark, column, tmp_path):
    assert column(numbers.to_int_or_zero, ["3000000000", "x", None, "-7.9"]) == [3_000_000_000, 0, 0, -7]
    head = "transaction_id,date_transaction,client_id,produit_id,magasin_id,quantite,prix_unitaire_xaf,montant_total_xaf,mode_paiement,canal_vente,statut\n"
    line = "T1,{0},C1,P1,M1,1,1000,1000,Virement,Magasin,Validé\n"
    (tmp_path / "t.csv").write_text(head + line.format("2024-01-02 08:00:00") + line.format("2024-01-02 17:30:00"))
    tx = files.extract_transactions(spark, str(tmp_path / "t.csv"))
    assert [r["date_transaction"].hour for r in tx.collect()] == [8, 17]
    kept = X.reject_routing(tx, ["date_transaction"]).collect()
    assert [r["date_transaction"].hour for r in kept] == [17]


def test_all_messages_of_a_row(spark):
    df = spark.createDataFrame([(None, None, "x", "?", "?")], "client_id string, nom string, email string, ville string, categorie string")
    assert Q.error_details(df, rules.client_rules()).count() == 5
    assert Q.error_details(df, rules.client_rules(), per_row=3).count() == 3


def test_routing_shuffles_on_values_alone(spark, facts):
    tx = facts.withColumn("transaction_id", F.when(F.col("quantite") == 0, "").otherwise(F.col("transaction_id")))
    routed = X.reject_routing(tx.unionByName(tx), ["date_transaction"])
    assert "monotonically_increasing_id" not in plan(routed)
    assert routed.where("transaction_id = ''").count() == 30 and routed.count() == 75


def test_distinct_counts_do_not_multiply_the_fact(spark, facts):
    products = spark.createDataFrame([(f"P{i}", "n", "c") for i in range(4)], "produit_id string, nom_produit string, categorie string")
    for out in (A.product_sales(facts), A.product_sales(facts, products), A.store_performance(facts),
                M.client_metrics(facts, "2024-04-01"), M.product_performance(facts)):
        assert "Expand" not in plan(out)
    assert rows(A.product_sales(facts, products), "produit_id", "nb_clients", "nb_magasins") == [(f"P{i}", 7, 3) for i in range(4)]
    without = A.product_sales(facts.drop("magasin_id"))
    assert "nb_magasins" not in without.columns and "nb_clients" in without.columns


def test_an_append_during_an_upsert_stays(spark, folder, monkeypatch):
    schema = "k string, v int"
    W.load_table(spark.createDataFrame([("a", 1)], schema), folder, "staging.t")
    plain, appended = W.upsert, []

    def slow(target, updates, keys):
        if not appended:
            appended.append(1)
            W.load_table(spark.createDataFrame([("b", 1)], schema), folder, "staging.t", W.APPEND)
        return plain(target, updates, keys)

    monkeypatch.setattr(W, "upsert", slow)
    W.load_table(spark.createDataFrame([("c", 1)], schema), folder, "staging.t", W.UPSERT, ["k"], ["v"])
    assert rows(W.read_table(spark, folder, "staging.t")) == [("a", 1), ("b", 1), ("c", 1)]


def test_a_rewrite_of_what_is_no_longer_current_is_done_again(spark, folder, monkeypatch):
    schema = "k string, v int"
    W.load_table(spark.createDataFrame([("a", 1)], schema), folder, "staging.t")
    plain, other = W.upsert, []

    def slow(target, updates, keys):
        if not other:
            other.append(1)
            W.load_table(spark.createDataFrame([("a", 2)], schema), folder, "staging.t", W.UPSERT, ["k"], ["v"])
        return plain(target, updates, keys)

    monkeypatch.setattr(W, "upsert", slow)
    W.load_table(spark.createDataFrame([("c", 1)], schema), folder, "staging.t", W.UPSERT, ["k"], ["v"])
    assert rows(W.read_table(spark, folder, "staging.t")) == [("a", 2), ("c", 1)]


def test_upserts_rewrite_touched_pieces_and_old_ones_can_go(spark, folder):
    schema = "k string, v int"
    base = spark.createDataFrame([(f"k{i}", 0) for i in range(200)], schema)
    W.load_table(base, folder, "staging.t", W.UPSERT, ["k"], ["v"], buckets=16)
    before = set(W.current_pieces(spark, folder, "staging.t"))
    row = W.load_table(spark.createDataFrame([("k7", 1)], schema), folder, "staging.t", W.UPSERT, ["k"], ["v"], buckets=16).first()
    assert (row["nb_lignes_inserees"], row["nb_lignes_mises_a_jour"], len(row["remplace"])) == (0, 1, 1)
    after = set(W.current_pieces(spark, folder, "staging.t"))
    assert len(before & after) == len(before) - 1
    folders = len(os.listdir(f"{folder}/staging/t"))
    W.load_table(base.where("false"), folder, "staging.t", W.UPSERT, ["k"], ["v"], buckets=16)
    assert len(os.listdir(f"{folder}/staging/t")) == folders
    gone = W.vacuum(spark, folder, "staging.t", dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(minutes=1))
    assert len(gone) == 1 and not os.path.exists(gone[0].removeprefix("file:"))
    assert W.read_table(spark, folder, "staging.t").count() == 200
    W.compact(spark, folder, "staging.t")
    assert len(W.current_pieces(spark, folder, "staging.t")) == 1 and W.read_table(spark, folder, "staging.t").count() == 200


def test_repeated_days_change_nothing(spark, folder, tmp_path):
    rejected = spark.createDataFrame([("a", "m"), ("b", "n")], "k string, motif_rejet string")
    for _ in range(2):
        SF.write_rejects(rejected, f"{folder}/r", "2024-01-01")
    assert spark.read.option("header", True).csv(f"{folder}/r").count() == 2
    assert not SF.write_rejects(rejected.where("false"), f"{folder}/r", "2024-01-01")
    assert not os.path.exists(f"{folder}/r/date_rejet=2024-01-01")
    (tmp_path / "a.csv").write_text("id,n\na,1\nb\n")
    for _ in range(2):
        SF.bronze_ingest(spark, str(tmp_path / "a.csv"), f"{folder}/b", dt.datetime(2024, 5, 6, 7))
    assert spark.read.parquet(f"{folder}/b").count() == 2


def test_merges_into_months_read_those_months(spark, folder):
    path, schema = f"{folder}/f", "k string, v int, annee int, mois int"
    fact = spark.createDataFrame([(f"k{i}", 1, 2024, 1 + i % 12) for i in range(120)], schema)
    SF.partitioned_fact(fact, path)
    touched = fact.where("mois = 3").limit(2).withColumn("v", F.lit(2))
    scan = spark.read.parquet(path).where((F.col("annee") == 2024) & (F.col("mois") == 3))
    assert len(scan.inputFiles()) >= 1
    listed = []
    original = SF.upsert

    def spying(current, updates, keys):
        listed.append(plan(current))
        return original(current, updates, keys)

    SF.upsert = spying
    try:
        SF.upsert_partitions(touched, path, ["k", "annee", "mois"])
    finally:
        SF.upsert = original
    assert "PartitionFilters: [" in listed[0] and "3" in listed[0].split("PartitionFilters: [")[1].split("]")[0]
    assert spark.read.parquet(path).agg(F.sum("v")).first()[0] == 122


def test_tests_of_absent_tables_are_listed(spark):
    clients = spark.createDataFrame([("C1", "n")], "client_id string, nom string")
    out = CT.run_column_tests({"clients": clients}, CT.TABLE_CONSTRAINTS)
    assert out.count() == len(CT.TABLE_CONSTRAINTS)
    assert {r["status"] for r in out.where("table <> 'clients'").collect()} == {"NON EXÉCUTÉ"}


def test_incremental_runs_take_what_is_new(spark, folder):
    schema = "k string, v int, date_maj timestamp_ntz"
    first = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1)), ("b", 1, dt.datetime(2024, 1, 2))], schema)
    assert daily.run_increment(first, folder, "ventes", ["k"]).first()["nb_lignes_source"] == 2
    second = first.unionByName(spark.createDataFrame([("a", 5, dt.datetime(2024, 1, 3))], schema))
    assert daily.run_increment(second, folder, "ventes", ["k"]).first()["nb_lignes_source"] == 1
    assert rows(W.read_table(spark, folder, "staging.ventes"), "k", "v") == [("a", 5), ("b", 1)]
    stages = W.pipeline_summary(W.read_journal(spark, folder), W.stage_counts("source", {"ventes": second}))
    assert rows(stages, "etape", "nom_table", "nb_lignes")[0] == ("source", "ventes", 3)


def test_a_run_leaves_nothing_behind(spark):
    with scratch(spark):
        inside = materialise(spark.range(3).toDF("k"), "t").inputFiles()[0].removeprefix("file:")
        assert os.path.exists(inside)
    assert not os.path.exists(os.path.dirname(os.path.dirname(inside)))


def test_the_fact_is_read_once_for_the_quality_summary(spark):
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    out = entry_points.queries()["quality_summary"](spark, folder)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("l_shipdate") == 0
