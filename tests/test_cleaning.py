"""Client and transaction cleaning."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from etalage import contracts as K
from etalage.operators import clients as C, staging as S, transactions as X

from comparison import rows

D = dt.date
CLIENT = ("client_id string, nom string, prenom string, email string, telephone string, ville string, "
          "date_inscription string, sexe string, categorie string, n int")
TX = ("transaction_id string, date_transaction date, client_id string, produit_id string, magasin_id string, "
      "quantite int, prix_unitaire_xaf decimal(15,2), montant_total_xaf decimal(15,2), statut string, "
      "canal_vente string, mode_paiement string, n int")


def tx(spark, *lines):
    out = []
    for n, (id_, q, p, m) in enumerate(lines):
        out.append((id_, D(2024, 1, 6), "C1", "P1", "M1", q, p and Decimal(p), m and Decimal(m), "Validé", "En ligne",
                    "Virement", n))
    return spark.createDataFrame(out, TX)


def test_clients_are_standardised_deduplicated_and_enriched(spark):
    df = spark.createDataFrame([
        ("C1", " old ", "a", "x@y.cg", "", "bzv", "2024-01-01", "m", "vip", 1),
        ("C1", " new ", "jean-PAUL", "X@Y.cg", "061234567", "bzv", "2024-01-01", "homme", "prem", 2),
        ("C2", "b", None, "x@y.cg ", None, "Paris", None, None, "?", 3),
        ("C3", "c", "c", "", None, None, "2023-12-31", "f", "std", 4),
        ("C4", "d", "d", None, None, "PNR", "2024-10-02", "f", "std", 5),
        ("", "e", "e", "", None, "pnr", "2024-10-02", "f", "std", 6),
        ("C6", None, "e", "", None, "pnr", "2024-10-02", "f", "std", 7),
    ], CLIENT)
    out = {r["client_id"]: r for r in C.clean_clients(df, "2024-12-31", ["n"]).collect()}
    # C1's newer row loses its address to C2; rows without address all stay
    assert sorted(out) == ["C2", "C3", "C4"]
    assert (out["C2"]["sexe"], out["C2"]["categorie"], out["C2"]["region"], out["C2"]["prenom"]) == (
        "Inconnu", "Standard", "Autre", "")
    assert (out["C2"]["anciennete_jours"], out["C2"]["segment_anciennete"]) == (0, None)
    assert (out["C3"]["anciennete_jours"], out["C3"]["segment_anciennete"]) == (366, "Très fidèle")
    assert (out["C4"]["segment_anciennete"], out["C4"]["region"], out["C4"]["est_premium"]) == (
        "Nouveau", "Kouilou", False)


def test_rows_without_id_or_address_form_no_common_group(spark):
    df = spark.createDataFrame([(f"C{i}", None if i % 2 else "", i) for i in range(30)],
                               "client_id string, email string, n int")
    assert C.dedup_clients(df, ["n"]).count() == 30


def test_amounts_are_corrected_and_uncheckable_ones_become_null(spark):
    df = X.amount_coherence(tx(spark, ("a", 2, "10", "21"), ("b", 2, "10", "21.01"), ("c", 2, None, "20"),
                               ("d", 2, "10", None)))
    got = {r["transaction_id"]: (r["montant_coherent"], r["montant_total_xaf"]) for r in df.collect()}
    assert got == {"a": (True, Decimal("21.00")), "b": (False, Decimal("20.00")), "c": (False, None),
                   "d": (False, Decimal("20.00"))}


def test_rejects_are_routed_by_the_first_broken_rule(spark):
    df = tx(spark, (None, 1, "600", "600"), ("", 1, "600", "600"), ("a", 1, "600", "600"), ("a", 1, "700", "700"),
            ("b", 1, "499", "499"), ("c", 0, "900", "900"), ("d", 1, None, "900"), ("e", -1, "900", "899.5"))
    routed = X.reject_routing(df, ["n"])
    got = sorted((r["transaction_id"] or "", r["motif_rejet"]) for r in routed.collect())
    # a quantity of zero is corrected to a total of zero first, so the amount rule catches it
    assert got == [("", K.REASON_MISSING_ID), ("", K.REASON_MISSING_ID), ("a", None), ("b", K.REASON_AMOUNT),
                   ("c", K.REASON_AMOUNT), ("d", K.REASON_AMOUNT), ("e", K.REASON_AMOUNT)]
    valid, rejected = X.split_rejects(routed)
    duplicates = 1
    assert valid.count() + rejected.count() + duplicates == df.count()
    assert rows(valid, "montant_total_xaf") == [(Decimal("700.00"),)]


def test_the_quantity_rule_still_stands_behind_the_amount_rule(spark):
    df = spark.createDataFrame([("a", Decimal("900"), 0)],
                               "transaction_id string, montant_total_xaf decimal(15,2), quantite int")
    assert df.select(X.reject_reason()).first()[0] == K.REASON_QUANTITY


def test_calendar_columns(spark):
    df = spark.createDataFrame([(D(2024, 12, 30),), (D(2024, 6, 1),), (None,)], "date_transaction date")
    got = [tuple(r)[1:] for r in X.time_dimensions(df).orderBy(F.asc_nulls_last("date_transaction")).collect()]
    assert got == [(2024, 6, 2, 22, "Saturday", True, "2024-06", "Juin"),
                   (2024, 12, 4, 1, "Monday", False, "2024-12", "Décembre"),
                   (None, None, None, None, None, False, None, None)]


def test_cleaned_transactions_keep_unmatched_rows(spark):
    facts = tx(spark, ("a", 1, "600", "600"), ("b", 1, "600", "600"), (None, 1, "600", "600"))
    products = spark.createDataFrame([("P1", "x", "cat")], "produit_id string, nom_produit string, categorie string")
    stores = spark.createDataFrame([("M9", "m", "v")], "magasin_id string, nom_magasin string, ville string")
    valid, rejected = X.clean_transactions(facts, ["n"], None, products, stores)
    assert rows(valid, "transaction_id", "categorie_produit", "nom_magasin", "est_outlier") == [
        ("a", "cat", None, False), ("b", "cat", None, False)]
    assert rejected.count() == 1


def test_staged_transactions(spark):
    base = tx(spark, ("a ", 2, "100000", "200000"), ("a", 1, "600", "600"), ("b", 1, "50000", "50000"),
              ("c", 0, "600", "600"), ("", 1, "600", "600"), (None, 1, "600", "600"), ("d", 1, "1", "1"))
    cancelled = tx(spark, ("e", 1, "600", "600")).withColumn("statut", F.lit(" Annulé"))
    unknown = tx(spark, ("f", 1, "600", "600")).withColumn("statut", F.lit(None).cast("string"))
    undated = tx(spark, ("g", 1, "600", "600")).withColumn("date_transaction", F.lit(None).cast("date"))
    out = S.stg_transactions(base.unionByName(cancelled).unionByName(unknown).unionByName(undated), tiebreak=["n"])
    got = {r["transaction_id"]: (r["segment_montant"], r["montant_recalcule_xaf"], r["jour_semaine"]) for r in out.collect()}
    assert got == {"a": ("Grande transaction", Decimal("200000.00"), "Saturday"),
                   "b": ("Transaction moyenne", Decimal("50000.00"), "Saturday")}


def test_staged_clients_take_the_latest_registration(spark):
    df = spark.createDataFrame([
        ("C1 ", "Li", "pointe-noire", "A@B.CG", "", "pointe-noire", "2024-01-01", "m", "VIP", 1),
        ("C1", " li ", "éric", "A@B.CG", "", "Pointe-Noire", None, "x", "Or", 2),
        ("C2", "", "b", "", "", "", "2024-01-01", "f", "Standard", 3),
    ], CLIENT).withColumn("quartier", F.lit("bas-congo"))
    (row,) = S.stg_clients(df, ["n"]).collect()
    # a missing date sorts before all others in a descending order
    assert (row["nom"], row["nom_complet"], row["departement"], row["sexe_libelle"], row["quartier"]) == (
        "LI", "li Éric", "Kouilou", "Non renseigné", "Bas-Congo")


def test_staged_products_and_stores(spark):
    products = spark.createDataFrame([
        (" P1", "n", "télé-phonie", "a b", Decimal(p), 1, "f", c)
        for p, c in [("300000", "RDC"), ("50000", " Congo "), ("10000", "Chine"), ("9999.99", None)]
    ], "produit_id string, nom_produit string, categorie string, sous_categorie string, "
       "prix_unitaire_xaf decimal(15,2), stock_initial int, fournisseur string, pays_origine string")
    got = rows(S.stg_products(products), "segment_prix", "est_produit_local", "categorie")
    assert got == [("Bas prix", False, "Télé-Phonie"), ("Prix abordable", False, "Télé-Phonie"),
                   ("Prix moyen", True, "Télé-Phonie"), ("Prix élevé", True, "Télé-Phonie")]
    stores = spark.createDataFrame([
        ("M1", "n", "Ouesso", "q", "a", "r", "t", 600, D(2020, 2, 29), "Actif "),
        ("M2", "n", "Paris", "q", "a", "r", "t", 349, None, "Actif"),
        ("M3", "n", "Ouesso", "q", "a", "r", "t", 600, D(2020, 2, 29), "Fermé"),
    ], "magasin_id string, nom_magasin string, ville string, quartier string, adresse string, responsable string, "
       "telephone string, surface_m2 int, date_ouverture date, statut string")
    got = rows(S.stg_stores(stores, "2023-02-28"), "magasin_id", "zone_commerciale", "taille_magasin", "anciennete_annees")
    assert got == [("M1", "Zone Nord", "Grand", 2), ("M2", "Autre zone", "Petit", None)]


def test_routing_cuts_groups_before_the_shuffle_and_spares_rows_without_id(spark, folder):
    tx(spark, (None, 1, "600", "600"), ("a", 1, "600", "600")).write.parquet(f"{folder}/tx")
    routed = X.reject_routing(spark.read.parquet(f"{folder}/tx"), ["n"])
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 1
    assert "row_number(), 1, Partial" in plan
