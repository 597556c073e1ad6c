"""Aggregates, segments and marts on hand-made tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from etalage.operators import aggregates as A, marts as M
from etalage.operators.transactions import time_dimensions
from etalage.plans import daily

from comparison import rows

D = dt.date
FACT = ("transaction_id string, date_transaction date, client_id string, produit_id string, magasin_id string, "
        "quantite int, prix_unitaire_xaf decimal(15,2), montant_total_xaf decimal(15,2)")


@pytest.fixture
def facts(spark):
    lines = [("1", D(2024, 1, 5), "C1", "P1", "M1", 1, 100, 100), ("2", D(2024, 1, 9), "C1", "P2", "M1", 2, 50, 105),
             ("3", D(2024, 1, 9), "C2", "P1", "M2", 1, 300, 300), ("4", D(2024, 3, 1), None, "P1", "M1", 1, 200, 200),
             ("5", D(2024, 3, 1), "C2", "P3", None, 1, 300, 300)]
    df = spark.createDataFrame([(*x[:6], Decimal(x[6]), Decimal(x[7])) for x in lines], FACT)
    return time_dimensions(df)


def test_monthly_revenue_drops_rows_without_a_key(facts):
    out = A.monthly_revenue(facts)
    got = rows(out, "mois_annee", "magasin_id", "nb_transactions", "nb_clients_uniques", "ca_moyen_par_transaction_xaf",
               "ca_moyen_par_client_xaf")
    assert got == [("2024-01", "M1", 2, 1, 102.0, 205.0), ("2024-01", "M2", 1, 1, 300.0, 300.0),
                   ("2024-03", "M1", 1, 0, 200.0, None)]


def test_top_products_rank_and_share_before_the_cut(facts):
    got = [(r["produit_id"], r["rang_ca"], r["part_ca_pct"]) for r in A.top_products(facts, 2).orderBy("rang_ca").collect()]
    assert got == [("P1", 1, 59.7), ("P3", 2, 29.85)]


def test_store_performance(facts):
    got = rows(A.store_performance(facts), "magasin_id", "rang_ca", "panier_moyen_xaf", "ca_mensuel_moyen_xaf", "nb_produits_vendus")
    assert got == [("M1", 1, 135.0, 17.0, 2), ("M2", 2, 300.0, 12.0, 1)]


def test_activity_counts_recency_from_the_latest_date_of_all(facts):
    assert rows(A.client_activity(facts), "client_id", "recence_jours", "nb_transactions") == [("C1", 52, 2), ("C2", 0, 2)]


def test_orientations_mirror_each_other(spark):
    lines = [(str(i), D(2024, 1, 1) + dt.timedelta(days=i), f"C{i % 10}", "P", "M", 1, Decimal(1), Decimal(i * 10 + 5))
             for i in range(55)]
    df = spark.createDataFrame(lines, FACT)
    best = {r["client_id"]: r for r in A.rfm_quantile(df).collect()}
    literal = {r["client_id"]: r for r in A.rfm_quantile(df, "literal").collect()}
    for client, row in best.items():
        for s in ("score_R", "score_F", "score_M"):
            assert row[s] + literal[client][s] == 6
    assert best["C4"]["score_R"] == 5 and best["C5"]["score_R"] == 1
    with pytest.raises(ValueError):
        A.rfm_quantile(df, "sideways")
    shares = A.segment_distribution(A.rfm_quantile(df)).agg(F.sum("nb_clients"), F.sum("part_pct")).first()
    assert tuple(shares) == (10, 100.0)


def test_dashboard_and_growth(spark, facts):
    monthly = A.monthly_revenue(facts)
    daily.register_views(spark, monthly)
    board = spark.table("v_tableau_bord_executif").first()
    assert (board["derniere_periode"], board["ca_total_global_xaf"], board["nb_clients_actifs"], board["nb_magasins_actifs"],
            board["panier_moyen_global_xaf"]) == ("2024-03", Decimal("705.00"), 2, 2, Decimal(201))
    growth = rows(spark.table("v_evolution_ca"), "mois_annee", "ca_mois_precedent_xaf", "croissance_mois_pct")
    assert growth == [("2024-01", None, None), ("2024-03", Decimal("505.00"), Decimal("-60.40"))]


def test_tables_are_put_out_in_their_order(facts):
    got = [(r["mois_annee"], r["magasin_id"]) for r in daily.ordered("ca_mensuel", A.monthly_revenue(facts)).collect()]
    assert got == [("2024-01", "M2"), ("2024-01", "M1"), ("2024-03", "M1")]


@pytest.fixture
def staged(facts):
    return facts.withColumns({
        "canal_vente": F.when(F.col("transaction_id") == "2", "Magasin").otherwise("En ligne"),
        "est_vente_en_ligne": F.col("transaction_id") != "2",
        "mode_paiement": F.when(F.col("transaction_id") < "3", "Virement").otherwise("Espèces")})


@pytest.fixture
def dimensions(spark):
    clients = spark.createDataFrame([("C1", "Dolisie", "Niari", "VIP", True), ("C3", "Dolisie", "Niari", "VIP", True)],
                                    "client_id string, ville string, departement string, categorie_client string, "
                                    "est_client_premium boolean").withColumn("telephone", F.lit("x"))
    products = spark.createDataFrame([("P1", "n", "c", "s", "Bas prix", Decimal("9.00")), ("P9", "n", "c", "s", "Bas prix", Decimal("8.00"))],
                                     "produit_id string, nom_produit string, categorie string, sous_categorie string, "
                                     "segment_prix string, prix_unitaire_xaf decimal(15,2)")
    stores = spark.createDataFrame([("M1", "n", "v", "z", "t")], "magasin_id string, nom_magasin string, ville string, "
                                                               "zone_commerciale string, taille_magasin string")
    return clients, products, stores


def test_sales_mart_keeps_unmatched_rows_under_null_keys(staged, dimensions):
    out = M.sales_mart(staged, *dimensions)
    got = rows(out, "mois_annee", "magasin_id", "categorie_produit", "nb_transactions", "nb_clients_uniques",
               "ca_total_xaf", "taux_vente_en_ligne_pct", "part_ca_premium_pct", "nb_virement")
    assert got == [
        ("2024-01", "M1", "c", 1, 1, Decimal("100.00"), Decimal("100.00"), Decimal("100.00"), 1),
        ("2024-01", "M1", None, 1, 1, Decimal("105.00"), Decimal("0.00"), Decimal("100.00"), 1),
        ("2024-01", None, "c", 1, 0, Decimal("300.00"), Decimal("100.00"), Decimal("0.00"), 0),
        ("2024-03", "M1", "c", 1, 0, Decimal("200.00"), Decimal("100.00"), Decimal("0.00"), 0),
        ("2024-03", None, None, 1, 0, Decimal("300.00"), Decimal("100.00"), Decimal("0.00"), 0)]


def test_client_metrics(staged):
    got = {r["client_id"]: r for r in M.client_metrics(staged, "2024-03-31").collect()}
    one = got["C1"]
    assert (one["nb_achats_total"], one["nb_mois_actifs"], one["nb_annees_actif"], one["recence_jours"]) == (2, 1, 1, 82)
    # a tie between channels goes to the first in sort order
    assert (one["canal_prefere"], one["mode_paiement_prefere"], one["frequence_mensuelle"]) == (
        "En ligne", "Virement", Decimal("2.00"))
    assert got["C2"]["nb_magasins_frequentes"] == 1 and None in got


def test_client_mart_defaults(staged, dimensions):
    got = {r["client_id"]: r for r in M.client_mart(dimensions[0], staged, "2024-03-31").collect()}
    never = got["C3"]
    assert (never["recence_jours"], never["score_recence"], never["segment_rfm"], never["est_client_actif"],
            never["ca_total_xaf"], never["premiere_transaction"]) == (9999, 1, "Jamais acheté", False, 0, None)
    assert got["C1"]["panier_moyen_xaf"] == 103 and got["C1"]["est_client_actif"] and "telephone" not in got["C1"]


def test_product_mart(staged, dimensions):
    got = {r["produit_id"]: r for r in M.product_mart(dimensions[1], staged).collect()}
    sold, unsold = got["P1"], got["P9"]
    assert (sold["rang_ca"], sold["rang_volume"], sold["part_ca_pct"], sold["categorie_performance"]) == (
        1, 1, Decimal("59.70"), "Top 10 CA")
    assert (sold["ca_moyen_par_vente_xaf"], sold["prix_min_observe_xaf"], sold["taux_vente_en_ligne_pct"]) == (
        200, Decimal("100.00"), Decimal("100.00"))
    assert (unsold["rang_ca"], unsold["prix_min_observe_xaf"], unsold["taux_vente_en_ligne_pct"],
            unsold["categorie_performance"]) == (999, Decimal("8.00"), None, "Aucune vente")


def test_segments(spark):
    cases = [(4, 4, 4, 0, "Champions"), (3, 3, 3, 0, "Clients fidèles"), (2, 3, 1, 0, "Clients à risque"),
             (1, 1, 1, 181, "Clients inactifs"), (1, 1, 1, 180, "Clients en développement")]
    df = spark.createDataFrame(cases, "score_recence int, score_frequence int, m int, recence_jours int, want string")
    total = F.col("score_recence") + F.col("score_frequence") + F.col("m")
    assert all(r[0] == r[1] for r in df.select(M.rfm_segment(total), "want").collect())


@pytest.mark.parametrize("columns", [["magasin_id", "nb_transactions", "ca_total_xaf"], ["client_id", "segment_rfm", "ca_total_xaf"],
                                     ["produit_id", "categorie_performance"], ["nb_clients_uniques", "part_ca_premium_pct"],
                                     ["produit_id", "rang_volume", "nb_magasins_vendeurs", "taux_vente_en_ligne_pct"],
                                     ["client_id", "nb_mois_actifs", "panier_moyen_xaf", "nb_produits_differents", "est_client_actif"]])
def test_a_mart_wanted_in_some_columns_equals_those_of_the_whole(staged, dimensions, columns):
    marts = {"sales": lambda c: M.sales_mart(staged, *dimensions, columns=c),
             "clients": lambda c: M.client_mart(dimensions[0], staged, "2024-03-31", columns=c),
             "products": lambda c: M.product_mart(dimensions[1], staged, columns=c)}
    tried = 0
    for build in marts.values():
        whole = build(None)
        if set(columns) <= set(whole.columns):
            part, tried = build(columns), tried + 1
            assert sorted(part.columns) == sorted(columns)
            assert sorted(map(repr, part.select(columns).collect())) == sorted(map(repr, whole.select(columns).collect()))
    assert tried
