"""Joins of the facts to their dimensions.

No side is broadcast by hint: Spark broadcasts a dimension when its measured size is under the
configured limit, and otherwise sorts and merges, splitting hot keys of the fact side as it runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from etalage.operators.rows import column_slimming

# Dimension columns that the enriched fact carries, and their new names.
CLIENT_COLUMNS = ["client_id", "ville", "categorie", "sexe", "region"]
CLIENT_NAMES = {"ville": "ville_client", "categorie": "categorie_client"}
PRODUCT_COLUMNS = ["produit_id", "nom_produit", "categorie", "sous_categorie"]
PRODUCT_NAMES = {"categorie": "categorie_produit"}
STORE_COLUMNS = ["magasin_id", "nom_magasin", "ville"]
STORE_NAMES = {"ville": "ville_magasin"}


def enrich_dimensions(tx: DataFrame, clients: DataFrame | None = None, products: DataFrame | None = None,
                      stores: DataFrame | None = None) -> DataFrame:
    """Left-join each given dimension, narrowed to the columns it has; every transaction is kept."""
    plan = [
        (clients, "client_id", CLIENT_COLUMNS, CLIENT_NAMES),
        (products, "produit_id", PRODUCT_COLUMNS, PRODUCT_NAMES),
        (stores, "magasin_id", STORE_COLUMNS, STORE_NAMES),
    ]
    for dimension, key, wanted, renames in plan:
        if dimension is not None:
            tx = tx.join(column_slimming(dimension, wanted, renames), key, "left")
    return tx


def sales_star_join(tx: DataFrame, clients: DataFrame | None, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Fact, in those of its columns that are given, with the keys of the matched dimension rows: an unmatched key
    becomes null.  Without ``clients`` their columns are left out.
    """
    p = products.select(F.col("produit_id").alias("p_id"), "nom_produit",
                        F.col("categorie").alias("categorie_produit"), "sous_categorie", "segment_prix")
    m = stores.select(F.col("magasin_id").alias("m_id"), "nom_magasin",
                      F.col("ville").alias("ville_magasin"), "zone_commerciale", "taille_magasin")
    facts = column_slimming(tx, ["transaction_id", "date_transaction", "annee", "mois", "trimestre", "mois_annee",
                                 "nom_mois", "quantite", "prix_unitaire_xaf", "montant_total_xaf", "mode_paiement",
                                 "canal_vente", "est_vente_en_ligne", "client_id", "produit_id", "magasin_id"],
                            {"client_id": "t_client", "produit_id": "t_produit", "magasin_id": "t_magasin"})
    joined = (facts.join(m, F.col("t_magasin") == F.col("m_id"), "left")
                   .join(p, F.col("t_produit") == F.col("p_id"), "left"))
    if clients is not None:
        c = clients.select(F.col("client_id").alias("c_id"), F.col("ville").alias("ville_client"),
                           "departement", "categorie_client", "est_client_premium")
        joined = joined.join(c, F.col("t_client") == F.col("c_id"), "left")
    return joined.drop("t_client", "t_produit", "t_magasin").withColumnsRenamed(
        {"c_id": "client_id", "p_id": "produit_id", "m_id": "magasin_id"})


def dim_left_metrics(dimension: DataFrame, metrics: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Left-join aggregated metrics to their dimension; metrics without sales take their default."""
    joined = dimension.join(metrics, key, "left")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(value).cast(joined.schema[name].dataType))
                               for name, value in defaults.items()})
