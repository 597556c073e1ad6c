"""Tables of transactional databases over JDBC, and the two extracts made from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from etalage import contracts as K
from etalage.functions import dates


@dataclass(frozen=True)
class JdbcSplit:
    """How to read a table in parallel: ranges of a numeric or date column."""

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_options(url: str, table: str, split: JdbcSplit | None = None, fetch_size: int = 10_000,
                 properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options.  ``table`` is a table name or a bracketed query with an alias."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if split:
        options |= {"partitionColumn": split.column, "lowerBound": split.lower,
                    "upperBound": split.upper, "numPartitions": str(split.partitions)}
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, split: JdbcSplit | None = None,
              fetch_size: int = 10_000, properties: Mapping[str, str] | None = None) -> DataFrame:
    """A database table; later filters and column choices are pushed into its query."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, split, fetch_size, properties)).load()


def gross_amount(net: Column, vat_pct: Column) -> Column:
    """Net amount plus VAT, rounded half even to whole units."""
    return F.rint(net.cast("double") * (F.lit(1.0) + vat_pct.cast("double") / F.lit(100.0)))


def erp_orders(orders: DataFrame, sellers: DataFrame, start: str | dt.date = K.PERIOD_START,
               end: str | dt.date = K.PERIOD_END) -> DataFrame:
    """Orders of a period (both ends included) that are not deleted, with their seller.

    An order without status is left out as well, as a comparison with null is not true in SQL.
    """
    kept = orders.where(F.col("date_commande").cast("date").between(dates.day(start), dates.day(end))
                        & (F.col("statut_commande") != K.DELETED))
    named = kept.join(sellers.select("vendeur_id", "nom_commercial"), "vendeur_id", "left")
    return named.select("commande_id", "date_commande", "client_id", "montant_ht_xaf", "taux_tva",
                        gross_amount(F.col("montant_ht_xaf"), F.col("taux_tva")).alias("montant_ttc_xaf"),
                        "mode_livraison", "statut_commande", F.col("nom_commercial").alias("commercial_id"),
                        F.lit(K.SOURCE_ERP).alias("source"))


def price_history(prices: DataFrame) -> DataFrame:
    """Price changes, to be put out in ``price_history_order``."""
    return prices.select("produit_id", "ancien_prix_xaf", "nouveau_prix_xaf", "date_changement",
                         "motif_changement", "operateur_id")


def price_history_order() -> list[Column]:
    """By product, the latest change first."""
    return [F.asc_nulls_last("produit_id"), F.desc_nulls_first("date_changement")]
