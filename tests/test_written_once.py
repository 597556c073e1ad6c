"""A run writes each table that it loads once, where it stays, and keeps nothing longer than it is read."""

import os

import pytest
from pyspark.sql import functions as F

from etalage.functions import dates
from etalage.operators.transactions import clean_transactions
from etalage.plans import daily
from etalage.sinks import warehouse as W
from etalage.storage import scratch, shared_folder

ORDER = daily.ArrivalOrder(["date_inscription"], ["date_transaction", "montant_total_xaf"])


@pytest.fixture
def sources(spark):
    clients = [(f"C{i}", f"Nom{i}", "Ana", f"c{i}@mail.cg", "061234567", "Brazzaville", "Centre", "2023-01-05", "M", "VIP") for i in range(4)]
    sales = [(f"T{i % 30}" if i else None, f"2024-0{1 + i % 3}-15", f"M{i % 2}", f"P{i % 3}", 1 + i % 4, 1000 * (1 + i % 4), "Magasin", f"C{i % 4}",
              "Espèces", "Validé", 1000) for i in range(40)]
    products = [(f"P{i}", f"Produit {i}", "textile", "pagne", 1000, 5, "F", "Congo") for i in range(3)]
    stores = [(f"M{i}", f"Magasin {i}", "Dolisie", "Gare", "Avenue 1", "R", "061234567", 400, "2010-02-28", "Actif") for i in range(2)]
    return {
        "clients": spark.createDataFrame(clients, "client_id string, nom string, prenom string, email string, telephone string, ville string, "
                                                  "quartier string, date_inscription string, sexe string, categorie string"),
        "transactions": spark.createDataFrame(sales, "transaction_id string, date_transaction string, magasin_id string, produit_id string, "
                                              "quantite int, montant_total_xaf int, canal_vente string, client_id string, mode_paiement string, "
                                              "statut string, prix_unitaire_xaf int").withColumns({
                                                  c: F.col(c).cast("decimal(15,2)") for c in ("montant_total_xaf", "prix_unitaire_xaf")}),
        "produits": spark.createDataFrame(products, "produit_id string, nom_produit string, categorie string, sous_categorie string, "
                                                    "prix_unitaire_xaf int, stock_initial int, fournisseur string, pays_origine string"),
        "magasins": spark.createDataFrame(stores, "magasin_id string, nom_magasin string, ville string, quartier string, adresse string, "
                                                  "responsable string, telephone string, surface_m2 int, date_ouverture string, statut string"),
    }


def tables_in(folder: str) -> list[str]:
    return sorted({d.partition("-")[0] for _, found, _ in os.walk(folder) for d in found})


def test_a_daily_run_keeps_nothing_longer_than_it_is_read(spark, sources, folder, monkeypatch):
    kept, plain = {}, daily.load

    def load(tables, *more):
        kept["scratch"] = tables_in(shared_folder(spark).removeprefix("file:"))
        kept["fact"] = tables["transactions"].inputFiles()
        return plain(tables, *more)

    monkeypatch.setattr(daily, "load", load)
    ok, report = daily.run(sources, folder, "nuit", "2024-06-01", ORDER, 1, 100_000)
    assert ok and {r["nb_lignes_inserees"] for r in report.where("table_cible = 'staging.transactions'").collect()} == {30}
    assert report.where("table_cible = 'staging.transactions'").first()["nb_lignes_rejetees"] == 1
    assert report.count() == 11
    # the sources and the routed rows are gone when the loads begin, and the fact lies where it is read afterwards
    assert not {"source", "routed"} & set(kept["scratch"]) and "stg_transactions" in kept["scratch"]
    assert W.read_table(spark, folder, "staging.transactions").inputFiles() == kept["fact"]


def test_a_daily_run_that_fails_leaves_what_was_loaded_before(spark, sources, folder, monkeypatch):
    W.load_table(spark.range(3).toDF("k"), folder, "staging.clients")
    monkeypatch.setattr(daily, "write_rejects", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        daily.run(sources, folder, "nuit", "2024-06-01", ORDER, 1, 100_000)
    assert W.read_table(spark, folder, "staging.clients").count() == 3
    assert len(os.listdir(f"{folder}/staging/clients")) == 1 and os.listdir(f"{folder}/staging/transactions") == []


def test_statements_of_a_run_delete_their_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with scratch(spark):
        with scratch(spark):
            assert spark.conf.get(key) == "true"
        assert spark.conf.get(key) == "true"
        grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        assert sorted(r["k"] for r in grouped.collect()) == sorted(r["k"] for r in grouped.collect()) == list(range(7))
    assert spark.conf.get(key, None) == before


def test_the_cleaned_fact_joins_before_it_is_widened(spark, sources):
    valid, _ = clean_transactions(sources["transactions"], ORDER.transactions, sources["clients"], sources["produits"], sources["magasins"], 1, 100_000)
    names = valid.columns
    assert names[:4] == ["magasin_id", "produit_id", "client_id", "transaction_id"]
    assert names.index("est_outlier") < names.index("annee") < names.index("nom_mois") < names.index("ville_client") < names.index("nom_magasin")
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS mois_annee") < plan.index("Join LeftOuter")


def test_months_and_days_read_as_a_formatter_writes_them(spark):
    days = ["2024-02-29", "1582-10-04", "1582-10-15", "0999-12-31", "0001-01-01", "1000-01-01", "9999-12-31", "1969-12-31", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.col("d").cast("date"))
    df = df.unionByName(df.limit(1).select(F.date_add("d", 3_000_000).alias("d")))
    for ours, formatter in ((dates.month_key(F.col("d")), "yyyy-MM"), (dates.day_name(F.col("d")), "EEEE")):
        got = df.select(ours.alias("a"), F.date_format("d", formatter).alias("b")).collect()
        assert [r["a"] for r in got] == [r["b"] for r in got]
