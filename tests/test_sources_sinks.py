"""Readers, writers, the journal and the streams."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from etalage import contracts as K
from etalage.sinks import files as SF, warehouse as W
from etalage.sources import database as DB, feeds, files, increments
from etalage.storage import materialise, release, scratch_path
from etalage.streaming import increments as ST

from comparison import rows

CONTRACT = K.TableContract("demo", {"id": "text", "n": "int", "m": "money", "d": "date"})


def put(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return str(path)


def test_contract_types_and_missing_values(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'id,n,m,d,plus\n" a ",1.9,12.345,2024-02-30,x\n"b ""q"", r",x,nan,2024-02-29,\nNA,,-1,hier,NULL\n')
    got = rows(files.read_csv_contract(spark, path, CONTRACT))
    assert got == [("a", 1, Decimal("12.35"), None, "x"), ('b "q", r', 0, None, dt.date(2024, 2, 29), None),
                   (None, 0, Decimal("-1.00"), None, None)]


def test_contract_separator_encoding_and_line_breaks(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'id;n;m;d\n"é\nè";1;2;2024-01-01\n', "latin-1")
    got = files.read_csv_contract(spark, path, CONTRACT, encoding="ISO-8859-1", sep=";", multiline=True)
    assert got.first()["id"] == "é\nè"


def test_contract_violations(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_csv_contract(spark, str(tmp_path / "none.csv"), CONTRACT)
    path = put(tmp_path / "a.csv", "id,n\na,1\n")
    with pytest.raises(ValueError, match="d.*m"):
        files.read_csv_contract(spark, path, CONTRACT)


def test_files_of_one_folder_must_share_their_header(spark, tmp_path):
    folder = tmp_path / "many"
    os.mkdir(folder)
    put(folder / "1.csv", "id,n,m,d\na,1,1,2024-01-01\n")
    put(folder / "2.csv", "id,m,n,d\nb,2,2,2024-01-01\n")
    with pytest.raises(Exception, match="header does not conform"):
        files.read_csv_contract(spark, str(folder), CONTRACT).collect()


def test_jdbc_options_split_the_table():
    split = DB.JdbcSplit("date_commande", "2024-01-01", "2025-12-31", 24)
    got = DB.jdbc_options("jdbc:x:y", "commandes", split, properties={"user": "u"})
    assert got == {"url": "jdbc:x:y", "dbtable": "commandes", "fetchsize": "10000", "user": "u",
                   "partitionColumn": "date_commande", "lowerBound": "2024-01-01", "upperBound": "2025-12-31",
                   "numPartitions": "24"}


def test_erp_orders_follow_three_valued_logic(spark):
    orders = spark.createDataFrame([
        ("1", "2024-01-01", 1, 250, 18.0, "Livré"), ("2", "2025-12-31", 9, 100, 18.0, "Annulé"),
        ("3", "2024-05-05", 1, 100, 18.0, "Supprimé"), ("4", "2024-05-05", 1, 100, 18.0, None),
        ("5", "2026-01-01", 1, 100, 18.0, "Livré")],
        "commande_id string, date_commande string, vendeur_id int, montant_ht_xaf long, taux_tva double, statut_commande string")
    orders = orders.withColumns({"client_id": F.lit("C1"), "mode_livraison": F.lit("x")})
    sellers = spark.createDataFrame([(1, "Ada")], "vendeur_id int, nom_commercial string")
    assert rows(DB.erp_orders(orders, sellers), "commande_id", "montant_ttc_xaf", "commercial_id") == [
        ("1", 295.0, "Ada"), ("2", 118.0, None)]


def test_price_history_order(spark):
    df = spark.createDataFrame([("P2", 1, "2024-01-01"), ("P1", 2, "2024-01-01"), ("P1", 3, None), ("P1", 4, "2024-02-01")],
                               "produit_id string, nouveau_prix_xaf int, date_changement string")
    df = df.withColumns({"ancien_prix_xaf": F.lit(0), "motif_changement": F.lit(""), "operateur_id": F.lit("")})
    assert [r["nouveau_prix_xaf"] for r in DB.price_history(df).orderBy(*DB.price_history_order()).collect()] == [3, 4, 2, 1]


def test_feeds(spark, tmp_path):
    path = put(tmp_path / "p.json", "\n".join(json.dumps(x) for x in [
        {"produit_id": "P1", "prix_actuel_xaf": 110, "date_maj_prix": "2024-01-01T10:00:00"},
        {"produit_id": "P9", "prix_actuel_xaf": 25000}]))
    catalogue = spark.createDataFrame([("P1", Decimal("100.00"))], "produit_id string, prix_unitaire_xaf decimal(15,2)")
    landed = feeds.read_landed_json(spark, path, K.PRICE_FEED)
    assert rows(feeds.price_snapshot(landed, catalogue), "produit_id", "variation_pct") == [("P1", 10.0), ("P9", -50.0)]
    fx = spark.createDataFrame([("XAF_EUR", 0.00152449, dt.date(2024, 1, 1)), ("XAF", 1.0, dt.date(2024, 1, 2))], K.FX_FEED)
    assert rows(feeds.fx_pairs(fx), "devise_source", "devise_cible", "taux") == [("XAF", "EUR", 0.001524), ("XAF", None, 1.0)]
    assert feeds.fx_pairs(fx, "2024-01-02").count() == 1
    assert feeds.events_in_range(fx, "2024-01-01", "2024-01-01").count() == 1
    stock = spark.createDataFrame([("M1", "P1", 9, None), ("M1", "P2", 10, None), ("M2", "P1", 0, None)], K.STOCK_FEED)
    stores = spark.createDataFrame([("M1",)], "magasin_id string")
    assert rows(feeds.stock_levels(stock, stores), "produit_id", "alerte_rupture") == [("P1", True), ("P2", False)]


def test_increments_start_from_the_mark(spark):
    source = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03"), (4, None)], "i int, date_maj string")
    source = source.withColumn("date_maj", F.col("date_maj").cast("timestamp_ntz"))
    none = spark.createDataFrame([], "table_cible string, derniere_extraction timestamp_ntz")
    assert increments.incremental_extract(source, none, "v").count() == 4
    marks = increments.next_mark(source.where("i < 3"), "v")
    assert rows(increments.incremental_extract(source, marks, "v"), "i") == [(3,)]
    assert increments.next_mark(source.where("false"), "v").count() == 0


def test_replace_append_and_empty_loads(spark, folder):
    one, two = spark.range(3).toDF("k"), spark.range(10, 12).toDF("k")
    assert W.read_table(spark, folder, "staging.t") is None
    W.load_table(one, folder, "staging.t", run_id="r")
    W.load_table(two, folder, "staging.t", W.APPEND, run_id="r")
    assert W.read_table(spark, folder, "staging.t").count() == 5
    row = W.load_table(one.where("false"), folder, "staging.t", run_id="r").first()
    assert (row["statut"], row["nb_lignes_source"], row["emplacement"]) == (W.SKIPPED, 0, None)
    assert W.read_table(spark, folder, "staging.t").count() == 5
    W.load_table(two, folder, "staging.t", run_id="r")
    assert W.read_table(spark, folder, "staging.t").count() == 2
    assert rows(W.load_report(W.read_journal(spark, folder))) == [(W.SKIPPED, 1, 0), (W.DONE, 3, 7)]
    assert rows(W.pipeline_summary(W.read_journal(spark, folder))) == [("staging", "t", 2, W.DONE)]
    with pytest.raises(ValueError):
        W.load_table(one, folder, "staging.t", "merge")


def test_upsert_is_idempotent_and_the_last_update_wins(spark, folder):
    base = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, v int, n int")
    updates = spark.createDataFrame([("b", 2, 2), ("b", 3, 3), ("c", 4, 4)], "k string, v int, n int")
    W.load_table(base, folder, "marts.t")
    for _ in range(2):
        row = W.load_table(updates, folder, "marts.t", W.UPSERT, ["k"], ["n"]).first()
        assert rows(W.read_table(spark, folder, "marts.t"), "k", "v") == [("a", 1), ("b", 3), ("c", 4)]
    assert (row["nb_lignes_source"], row["nb_lignes_inserees"], row["nb_lignes_mises_a_jour"]) == (3, 0, 2)
    first = W.load_table(updates, folder, "marts.new", W.UPSERT, ["k"], ["n"]).first()
    assert (first["nb_lignes_inserees"], first["nb_lignes_mises_a_jour"]) == (2, 0)


def test_a_failed_load_is_journaled_and_changes_nothing(spark, folder):
    good = spark.range(3).toDF("k")
    W.load_table(good, folder, "staging.t", run_id="r")
    bad = good.withColumn("x", F.raise_error(F.lit("panne")).cast("string"))
    with pytest.raises(PySparkException):
        W.load_table(bad, folder, "staging.t", run_id="r")
    assert W.read_table(spark, folder, "staging.t").count() == 3
    failed = W.read_journal(spark, folder).where(F.col("statut") == W.FAILED).first()
    assert "panne" in failed["erreur"]
    ok, report = W.load_all({"clients": good}, {}, folder, "s")
    assert ok and report.count() == 1
    assert W.load_all({}, {}, folder, "s") == (True, None)


def test_rejects_and_stage(spark, folder):
    df = spark.createDataFrame([("a", "m 1"), ("b", "m 2")], "k string, motif_rejet string")
    assert SF.write_rejects(df, f"{folder}/r", "2024-01-01") and not SF.write_rejects(df.where("false"), f"{folder}/s", "2024-01-01")
    assert rows(spark.read.option("header", True).csv(f"{folder}/r"), "k", "motif_rejet") == [("a", "m 1"), ("b", "m 2")]
    assert not os.path.exists(f"{folder}/s")
    SF.write_stage_parquet(df, f"{folder}/stage")
    assert files.read_parquet_stage(spark, f"{folder}/stage").count() == 2


def test_partitioned_fact_replaces_only_its_months(spark, folder):
    df = spark.createDataFrame([(2024, 1, "a"), (2024, 2, "b")], "annee int, mois int, k string")
    SF.partitioned_fact(df, f"{folder}/f")
    SF.partitioned_fact(df.where("mois = 2").withColumn("k", F.lit("c")), f"{folder}/f")
    back = spark.read.parquet(f"{folder}/f")
    assert rows(back, "mois", "k") == [(1, "a"), (2, "c")]
    assert "PartitionFilters: [isnotnull(mois" in back.where("mois = 1")._jdf.queryExecution().executedPlan().toString()


def test_partitions_without_updates_are_left_alone(spark, folder):
    path, schema = f"{folder}/f", "k string, v int, annee int, mois int"
    SF.partitioned_fact(spark.createDataFrame([("a", 1, 2024, 1), ("b", 1, 2024, 2), ("c", 1, 2024, 2)], schema), path)
    untouched = set(os.listdir(f"{path}/annee=2024/mois=1"))
    SF.upsert_partitions(spark.createDataFrame([("b", 2, 2024, 2), ("d", 2, 2024, 3)], schema), path, ["k", "annee", "mois"])
    assert rows(spark.read.parquet(path), "k", "v", "mois") == [("a", 1, 1), ("b", 2, 2), ("c", 1, 2), ("d", 2, 3)]
    assert set(os.listdir(f"{path}/annee=2024/mois=1")) == untouched
    with pytest.raises(ValueError):
        SF.upsert_partitions(spark.createDataFrame([("b", 2, 2024, 2)], schema), path, ["k"])


def test_malformed_rows_are_quarantined(spark, folder, tmp_path):
    path = put(tmp_path / "a.csv", "id,n\na,1\nb\nc,3,4\n")
    SF.bronze_ingest(spark, path, f"{folder}/bronze", dt.datetime(2024, 5, 6, 7))
    bronze = spark.read.parquet(f"{folder}/bronze")
    assert rows(bronze, "etat", "id", "_corrupt_record") == [
        ("ok", "a", None), ("quarantaine", "b", "b"), ("quarantaine", "c", "c,3,4")]
    assert {str(r["ingest_date"]) for r in bronze.collect()} == {"2024-05-06"}


def test_streams_take_each_file_once(spark, folder):
    arrivals, root = f"{folder}/in", f"{folder}/w"
    schema = "k string, v int"

    def run(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(arrivals)
        ST.upsert_stream(spark, arrivals, spark.createDataFrame([], schema).schema, root, "staging.s", ["k"], ["v"],
                         f"{folder}/ck").awaitTermination()
        return rows(W.read_table(spark, root, "staging.s"))

    assert run(("a", 1), ("a", 2), ("b", 1)) == [("a", 2), ("b", 1)]
    assert run(("b", 5)) == [("a", 2), ("b", 5)]
    assert [r["nb_lignes_source"] for r in W.read_journal(spark, root).orderBy("fin_chargement").collect()] == [3, 1]


def test_written_tables(spark):
    df = spark.range(100).toDF("k")
    stored = materialise(df, "t")
    assert stored.count() == 100
    assert stored.inputFiles()[0].startswith("file:") and "etalage-" in stored.inputFiles()[0]
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    release(spark)
    assert not os.path.exists(stored.inputFiles()[0].removeprefix("file:"))


def test_compact_journal(spark, folder):
    """One file holds the rows of all loads; rows of a run that was cut short, or appended since, count once."""
    import glob
    import shutil
    assert W.compact_journal(spark, folder) == 0
    for i in range(4):
        W.load_table(spark.createDataFrame([(i, "a")], "id int, v string"), folder, "staging.t", W.APPEND, run_id=str(i))
    W.load_table(spark.createDataFrame([(0, "b"), (9, "b")], "id int, v string"), folder, "staging.t", W.UPSERT, ["id"], ["v"])
    before = rows(W.read_journal(spark, folder))
    table = rows(W.read_table(spark, folder, "staging.t"))
    own = lambda: glob.glob(f"{folder}/staging/journal_chargements/*.parquet")
    kept = own()[:2]
    for f in kept:
        shutil.copy(f, f"{folder}/{f.rpartition('/')[2]}")
    assert W.compact_journal(spark, folder) == 5 and len(own()) == 1
    assert rows(W.read_journal(spark, folder)) == before and rows(W.read_table(spark, folder, "staging.t")) == table
    assert W.compact_journal(spark, folder) == 0
    for f in kept:  # as if the run had ended before it deleted these
        shutil.copy(f"{folder}/{f.rpartition('/')[2]}", f)
    assert rows(W.read_journal(spark, folder)) == before and rows(W.read_table(spark, folder, "staging.t")) == table
    W.load_table(spark.createDataFrame([(20, "c")], "id int, v string"), folder, "staging.t", W.APPEND)
    assert rows(W.read_table(spark, folder, "staging.t")) == sorted([*table, (20, "c")], key=str)
    assert W.compact_journal(spark, folder) == 4 and len(rows(W.read_journal(spark, folder))) == 6
