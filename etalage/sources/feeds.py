"""Feeds that external services land as JSON: prices, exchange rates, events, stock levels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from etalage import contracts as K
from etalage.functions import dates
from etalage.functions.numbers import ratio, round_half_even


def read_landed_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines under a declared schema; nothing is inferred."""
    return spark.read.schema(schema).json(path)


def price_snapshot(landed: DataFrame, catalogue: DataFrame, default_price: int = K.DEFAULT_PRICE) -> DataFrame:
    """Current prices and their change in percent against the catalogue price.

    A product the catalogue lacks is compared with ``default_price``.
    """
    reference = catalogue.select("produit_id", F.col("prix_unitaire_xaf").alias("__ref"))
    joined = landed.join(reference, "produit_id", "left")
    ref = F.coalesce(F.col("__ref").cast("double"), F.lit(float(default_price)))
    change = ratio(F.col("prix_actuel_xaf").cast("double") - ref, ref)
    return joined.select("produit_id", "prix_actuel_xaf",
                         round_half_even(change * F.lit(100.0), 2).alias("variation_pct"),
                         "date_maj_prix", F.lit("API_CATALOGUE").alias("source"))


def fx_pairs(landed: DataFrame, date: str | dt.date | None = None) -> DataFrame:
    """Exchange rates with the pair ``AAA_BBB`` split into source and target currency."""
    if date is not None:
        landed = landed.where(F.col("date") == dates.day(date))
    pair = F.split("paire", "_")
    return landed.select(F.get(pair, F.lit(0)).alias("devise_source"), F.get(pair, F.lit(1)).alias("devise_cible"),
                         F.round("taux", 6).alias("taux"), "date", F.lit(K.SOURCE_FX).alias("source"))


def events_in_range(events: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Commercial events of a period, both ends included."""
    return events.where(F.col("date").between(dates.day(start), dates.day(end)))


def stock_levels(landed: DataFrame, stores: DataFrame | None = None, products: DataFrame | None = None,
                 low: int = K.LOW_STOCK) -> DataFrame:
    """Stock per store and product with an alert below ``low``, for the given stores and products."""
    if stores is not None:
        landed = landed.join(stores.select("magasin_id").distinct(), "magasin_id", "left_semi")
    if products is not None:
        landed = landed.join(products.select("produit_id").distinct(), "produit_id", "left_semi")
    return landed.select("magasin_id", "produit_id", "quantite_stock",
                         (F.col("quantite_stock") < low).alias("alerte_rupture"), "date_releve")
