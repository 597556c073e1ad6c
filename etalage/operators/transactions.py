"""Cleaning of the transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from etalage import contracts as K
from etalage.functions import dates
from etalage.functions.text import is_blank
from etalage.operators.joins import enrich_dimensions
from etalage.operators.quantiles import iqr_outliers
from etalage.operators.rows import keep_last
from etalage.storage import materialise


def amount_coherence(df: DataFrame, tolerance: float = K.AMOUNT_TOLERANCE) -> DataFrame:
    """Compare the total with quantity times price and replace incoherent totals.

    A gap that cannot be computed counts as incoherent; the total then becomes null.
    """
    expected = (F.col("quantite").cast("decimal(19,0)") * F.col("prix_unitaire_xaf")).try_cast(K.MONEY_SUM)
    df = df.withColumn("montant_calcule_xaf", expected)
    df = df.withColumn("ecart_montant_xaf",
                       F.abs(F.col("montant_total_xaf").cast(K.MONEY_SUM) - F.col("montant_calcule_xaf")))
    df = df.withColumn("montant_coherent", F.coalesce(F.col("ecart_montant_xaf") <= tolerance, F.lit(False)))
    return df.withColumn("montant_total_xaf",
                         F.when(F.col("montant_coherent"), F.col("montant_total_xaf").cast(K.MONEY_SUM))
                          .otherwise(F.col("montant_calcule_xaf")))


def time_dimensions(df: DataFrame, col: str = "date_transaction") -> DataFrame:
    """Calendar columns; all null for a missing date except the weekend flag, which is false."""
    df = df.withColumn(col, dates.to_day(F.col(col)))
    d = F.col(col)
    return df.withColumns({
        "annee": F.year(d),
        "mois": F.month(d),
        "trimestre": F.quarter(d),
        "semaine": F.weekofyear(d),
        "jour_semaine": dates.day_name(d),
        "est_weekend": F.coalesce(F.weekday(d) >= 5, F.lit(False)),
        "mois_annee": dates.month_key(d),
        "nom_mois": dates.month_name(d),
    })


def reject_reason(lo: float = K.AMOUNT_MIN, hi: float = K.AMOUNT_MAX) -> Column:
    """First broken rule of a row, null for an accepted one.  The amount rule precedes the quantity rule."""
    amount_ok = F.coalesce(F.col("montant_total_xaf").between(F.lit(lo), F.lit(hi)), F.lit(False))
    quantity_ok = F.coalesce(F.col("quantite") > 0, F.lit(False))
    return (F.when(is_blank(F.col("transaction_id")), K.REASON_MISSING_ID)
             .when(~amount_ok, K.REASON_AMOUNT)
             .when(~quantity_ok, K.REASON_QUANTITY))


def reject_routing(df: DataFrame, order_by: Sequence[str], lo: float = K.AMOUNT_MIN,
                   hi: float = K.AMOUNT_MAX) -> DataFrame:
    """Add ``motif_rejet`` to every row that survives de-duplication.

    Rows without id are rejected as they are: they skip the de-duplication, so none is lost and a source
    that leaves a third of the ids empty creates no hot group.  Their amounts are not checked.
    """
    no_id = F.coalesce(is_blank(F.col("transaction_id")), F.lit(True))
    kept = keep_last(df.where(~no_id), ["transaction_id"], order_by).unionByName(df.where(no_id))
    declared = F.col("montant_total_xaf").cast(K.MONEY_SUM)
    checked = amount_coherence(kept.withColumn("__declare", declared))
    unchecked = {c: F.when(~no_id, F.col(c)) for c in ("montant_calcule_xaf", "ecart_montant_xaf", "montant_coherent")}
    checked = checked.withColumns({
        **unchecked, "montant_total_xaf": F.when(no_id, F.col("__declare")).otherwise(F.col("montant_total_xaf"))})
    return checked.drop("__declare").withColumn("motif_rejet", reject_reason(lo, hi))


def split_rejects(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a routed table."""
    return (routed.where(F.col("motif_rejet").isNull()).drop("motif_rejet"),
            routed.where(F.col("motif_rejet").isNotNull()))


def clean_transactions(df: DataFrame, order_by: Sequence[str], clients: DataFrame | None = None,
                       products: DataFrame | None = None, stores: DataFrame | None = None,
                       lo: float = K.AMOUNT_MIN, hi: float = K.AMOUNT_MAX,
                       exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): route, mark outliers, add calendar and dimension columns.

    The routed table is written once, because the quartiles, the valid and the rejected rows all read
    it and the de-duplication shuffle behind it is the dearest step.
    """
    valid, rejected = split_rejects(materialise(reject_routing(df, order_by, lo, hi), "routed"))
    joined = enrich_dimensions(valid, clients, products, stores)
    # what follows from a row's own columns is added above the joins, which would otherwise move it along
    own, out = len(valid.columns), time_dimensions(iqr_outliers(joined, "montant_total_xaf", exact=exact, of=valid))
    added = [c for c in out.columns if c not in joined.columns]
    return out.select(*joined.columns[:own], *added, *joined.columns[own:]), rejected
