"""Revenue aggregates, product and store tables, client segmentation by quantiles.

Amounts are summed as decimals, so a total does not depend on the order of the rows.  Ratios are
doubles rounded half to even.  Rows with a missing group key are left out of these four tables.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from etalage import contracts as K
from etalage.functions.dates import month_key
from etalage.functions.numbers import exact_mean, percent_of, ratio, round_half_even
from etalage.operators.joins import STORE_COLUMNS, STORE_NAMES
from etalage.operators.quantiles import quantile_score, quantiles
from etalage.operators.ranking import global_rank
from etalage.operators.rows import column_slimming, read_often, top_k, with_distinct_counts
from etalage.storage import materialise

# The quintile edges, as products of the step, which is how evenly spaced fractions are computed.
QUINTILES = [i * 0.2 for i in range(1, 5)]

# Columns of the enriched fact that the four aggregates read.
AGGREGATED_COLUMNS = ["transaction_id", "date_transaction", "mois_annee", "client_id", "produit_id", "magasin_id", "nom_magasin",
                      "ville_magasin", "quantite", "montant_total_xaf", "prix_unitaire_xaf"]

# Sums and distinct counts per product, the latter with the column that they count.
PRODUCT_SUMS = ["nb_ventes", "quantite_totale", "ca_total_xaf", "prix_moyen_xaf"]
PRODUCT_COUNTS = {"nb_magasins": "magasin_id", "nb_clients": "client_id"}

# Quantile segments.
CHAMPIONS = "Champions"
LOYAL = "Clients fidèles"
AT_RISK = "Clients à risque"
INACTIVE = "Clients inactifs"


def _present(df: DataFrame, *names: str) -> list[str]:
    return [name for name in names if name in df.columns]


def _revenue(col: str = "montant_total_xaf") -> Column:
    return F.sum(F.col(col).cast(K.MONEY_SUM))


def monthly_revenue(tx: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    """Revenue per month and, where present, store town and store.

    Year, month and quarter follow from the month, so they are read off it afterwards and do not widen
    the keys that are shuffled.  Nor does the town, if ``stores`` gives it for a fact without it: each store
    stands there once, and the towns are joined to the result.  A fact without months is grouped by their first days.
    """
    dated = "mois_annee" not in tx.columns
    if dated:
        tx = tx.withColumn("mois_annee", F.trunc("date_transaction", "month"))
    keys = ["mois_annee", *_present(tx, "ville_magasin", "magasin_id")]
    out = tx.na.drop(subset=keys).groupBy(*keys).agg(
        F.count("transaction_id").alias("nb_transactions"),
        F.countDistinct("client_id").alias("nb_clients_uniques"),
        _revenue().alias("ca_total_xaf"),
        F.sum("quantite").alias("quantite_totale"),
        F.min("montant_total_xaf").alias("montant_min_xaf"),
        F.max("montant_total_xaf").alias("montant_max_xaf"),
    )
    if stores is not None:
        out = (store_labels(stores).select("magasin_id", "ville_magasin").na.drop().join(out, "magasin_id")
               .select("mois_annee", "ville_magasin", *out.columns[1:]))
    if dated:
        out = out.withColumn("mois_annee", month_key(F.col("mois_annee")))
    first, total = F.to_date(F.concat("mois_annee", F.lit("-01"))), F.col("ca_total_xaf")
    return out.select(
        "mois_annee", F.year(first).alias("annee"), F.month(first).alias("mois"),
        F.quarter(first).alias("trimestre"), *out.columns[1:],
        round_half_even(ratio(total, F.col("nb_transactions"))).alias("ca_moyen_par_transaction_xaf"),
        round_half_even(ratio(total, F.col("nb_clients_uniques"))).alias("ca_moyen_par_client_xaf"),
    )


def store_labels(stores: DataFrame) -> DataFrame:
    """The stores with the columns that the enriched fact carries, by the names they have there."""
    return column_slimming(stores, STORE_COLUMNS, STORE_NAMES)


def _asked(name: str, columns: Collection[str] | None) -> bool:
    return columns is None or name in columns


def _known_sales(tx: DataFrame, products: DataFrame | None, written: bool) -> tuple[list[str], DataFrame]:
    """The keys of the products and the rows that have them, in the columns that sales per product read."""
    keys = ["produit_id"] if products is not None else _present(tx, "produit_id", "nom_produit", "categorie_produit")
    return keys, read_often(tx.na.drop(subset=keys), [*keys, "transaction_id", "quantite", "montant_total_xaf",
                                                      "prix_unitaire_xaf", "magasin_id", "client_id"], written)


def _product_counts(tx: DataFrame, columns: Collection[str] | None) -> dict[str, str]:
    """The distinct counts per product that are wanted."""
    return {n: c for n, c in PRODUCT_COUNTS.items() if c in tx.columns and _asked(n, columns)}


def product_sales(tx: DataFrame, products: DataFrame | None = None, written: bool = False,
                  columns: Collection[str] | None = None) -> DataFrame:
    """Sales per product, with name and category where the catalogue is given.

    Rows are grouped by the product alone; the catalogue is joined to the result.  Products that it lacks, or has
    no name or category for, are left out then.  The fact is read three times, so the columns in use are
    written first, unless ``written`` says that the fact is a written table.  ``columns``: those wanted beside the
    keys; others are not computed.
    """
    keys, known = _known_sales(tx, products, written)
    out = known.groupBy(*keys).agg(
        F.count("transaction_id").alias("nb_ventes"),
        F.sum("quantite").alias("quantite_totale"),
        _revenue().alias("ca_total_xaf"),
        ratio(_revenue("prix_unitaire_xaf"), F.count("prix_unitaire_xaf")).alias("prix_moyen_xaf"),
    )
    out = with_distinct_counts(out, known, keys, _product_counts(tx, columns))
    out = out.select(*[c for c in out.columns if c in keys or _asked(c, columns)])
    if products is None:
        return out
    labels = products.select("produit_id", "nom_produit", F.col("categorie").alias("categorie_produit")).na.drop()
    return labels.join(out, "produit_id")


def top_products(tx: DataFrame, top_n: int = K.TOP_N, products: DataFrame | None = None, written: bool = False,
                 columns: Collection[str] | None = None) -> DataFrame:
    """Best sellers with rank and share among all products.

    The rank of a row depends on the rows above it only, so it is taken over the ``top_n`` rows, and so are the
    distinct counts, for which the fact is read again; the share divides by the total over all products.
    ``columns``: those wanted beside the keys and the revenue.
    """
    keys, known = _known_sales(tx, products, written)
    read = {c for c in PRODUCT_SUMS if _asked(c, columns)} | {"ca_total_xaf"}
    sales = materialise(product_sales(known, products, True, read), "sales")
    total = sales.agg(F.sum("ca_total_xaf").alias("total")).scalar()
    best = top_k(sales, top_n, F.desc("ca_total_xaf"), F.asc("produit_id"))
    counts = _product_counts(tx, columns)
    if counts:
        best = materialise(best, "best")  # Spark then knows that it is small
        sold = materialise(known.join(best.select(*keys), keys, "left_semi").select(*keys, *counts.values()), "sold")
        best = with_distinct_counts(best, sold, keys, counts)
    by_revenue = Window.orderBy(F.desc("ca_total_xaf"))  # over top_n rows
    share = ratio(F.col("ca_total_xaf"), total) * F.lit(100.0)
    return best.withColumns({"rang_ca": F.rank().over(by_revenue),
                             "part_ca_pct": round_half_even(share, 2)})


def store_performance(tx: DataFrame, months: int = K.STORE_MONTHS, written: bool = False,
                      columns: Collection[str] | None = None, stores: DataFrame | None = None) -> DataFrame:
    """Sales per store with its revenue rank; the monthly mean divides by a fixed number of months.

    The fact is read three times, so the columns in use are written first, unless ``written`` says that it is
    a written table.  ``columns``: those wanted; distinct counts beyond them are not taken.  ``stores``: each store
    once, with the names and towns of a fact without them; they are joined to the result.
    """
    keys = _present(tx, "magasin_id", "nom_magasin", "ville_magasin")
    known = read_often(tx.na.drop(subset=keys), [*keys, "transaction_id", "quantite", "montant_total_xaf", "client_id", "produit_id"],
                       written)
    out = known.groupBy(*keys).agg(
        F.count("transaction_id").alias("nb_transactions"),
        _revenue().alias("ca_total_xaf"),
        ratio(_revenue(), F.count("montant_total_xaf")).alias("ca_moyen_xaf"),
        F.sum("quantite").alias("quantite_totale"),
    )
    counts = {"nb_clients_uniques": "client_id", "nb_produits_vendus": "produit_id"}
    out = with_distinct_counts(out, known, keys, {n: c for n, c in counts.items() if c in tx.columns and _asked(n, columns)})
    if stores is not None:
        out = store_labels(stores).na.drop().join(out, "magasin_id")
    out = out.withColumns({
        "panier_moyen_xaf": round_half_even(F.col("ca_moyen_xaf")),
        "ca_mensuel_moyen_xaf": round_half_even(ratio(F.col("ca_total_xaf"), F.lit(months))),
    })
    return global_rank(out, "ca_total_xaf", "magasin_id", "rang_ca")


def client_activity(tx: DataFrame) -> DataFrame:
    """Recency, frequency and value per client; recency counts from the latest date of all.

    The per-client table is written, so the fact is scanned once for it and for the latest date.
    Rows without a client count for that date only.
    """
    per_client = materialise(tx.groupBy("client_id").agg(
        F.max("date_transaction").alias("derniere_transaction"),
        F.count("transaction_id").alias("nb_transactions"),
        _revenue().alias("ca_total_xaf"),
    ), "activity")
    latest = per_client.agg(F.max("derniere_transaction").alias("d")).scalar()
    return per_client.where(F.col("client_id").isNotNull()).withColumns({
        "recence_jours": F.datediff(latest, F.col("derniere_transaction")),
        "panier_moyen_xaf": round_half_even(ratio(F.col("ca_total_xaf"), F.col("nb_transactions"))),
    })


def quantile_segment(r: Column, f: Column, m: Column) -> Column:
    mean = (r + f + m) / F.lit(3.0)
    return (F.when(mean >= 4.0, CHAMPIONS)
             .when(mean >= 3.0, LOYAL)
             .when((r <= 2) & (mean >= 2.5), AT_RISK)
             .otherwise(INACTIVE))


def rfm_quantile(tx: DataFrame, orientation: str = "best_is_5", exact: bool = True) -> DataFrame:
    """Quintile scores, combined score and segment per client.

    ``best_is_5`` scores recent, frequent and valuable clients high; ``literal`` keeps the inverted
    scores of the original rule.
    """
    if orientation not in ("best_is_5", "literal"):
        raise ValueError(f"unknown orientation: {orientation}")
    best_is_5 = orientation == "best_is_5"
    clients = client_activity(tx)

    def score(col: str, rising: bool) -> Column:
        edges = quantiles(clients, col, QUINTILES, exact).scalar()
        return quantile_score(F.col(col), edges, len(QUINTILES) + 1, rising)

    scored = clients.withColumns({
        "score_R": score("recence_jours", rising=not best_is_5),
        "score_F": score("nb_transactions", rising=best_is_5),
        "score_M": score("ca_total_xaf", rising=best_is_5),
    })
    r, f, m = F.col("score_R"), F.col("score_F"), F.col("score_M")
    return scored.withColumns({"score_RFM": r * 100 + f * 10 + m, "segment_rfm": quantile_segment(r, f, m)})


def segment_distribution(rfm: DataFrame, segment: str = "segment_rfm") -> DataFrame:
    """Clients per segment and their share of all clients in percent."""
    counts = rfm.groupBy(segment).agg(F.count(F.lit(1)).alias("nb_clients"))
    total = rfm.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("part_pct", round_half_even(ratio(F.col("nb_clients"), total) * F.lit(100.0), 1))


def all_aggregates(tx: DataFrame, products: DataFrame | None = None,
                   columns: Mapping[str, Collection[str]] | None = None,
                   stores: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four aggregate tables.  Pass a written table: each of them reads only the columns it needs.  If it lacks
    the stores' names and towns, ``stores`` gives them, each store once; it may lack the months.

    A caller who reads some ``columns`` only names them by table.  Distinct counts beyond them are not taken and each
    table reads the fact once, so that it need not be written.
    """
    wanted = columns or {}
    return {
        "ca_mensuel": monthly_revenue(tx, stores),
        "top_produits": top_products(tx, products=products, written=True, columns=wanted.get("top_produits")),
        "performance_magasins": store_performance(tx, written=True, columns=wanted.get("performance_magasins"),
                                                  stores=stores),
        "segmentation_rfm": rfm_quantile(tx),
    }


def executive_dashboard(monthly: DataFrame) -> DataFrame:
    """One row of key figures.  ``nb_clients_actifs`` adds up per-group distinct counts: a client who
    buys in several months or stores is counted once in each."""
    return monthly.agg(
        F.max("mois_annee").alias("derniere_periode"),
        F.sum("ca_total_xaf").alias("ca_total_global_xaf"),
        F.sum("nb_transactions").alias("nb_transactions_total"),
        F.sum("nb_clients_uniques").alias("nb_clients_actifs"),
        F.round(exact_mean("ca_moyen_par_transaction_xaf"), 0).alias("panier_moyen_global_xaf"),
        F.countDistinct("magasin_id").alias("nb_magasins_actifs"),
        F.sum("quantite_totale").alias("quantite_totale_vendue"),
    )


def month_over_month(monthly: DataFrame) -> DataFrame:
    """Revenue per month with that of the month before and the growth in percent."""
    per_month = monthly.groupBy("mois_annee", "annee", "mois", "trimestre").agg(
        F.sum("ca_total_xaf").alias("ca_mensuel_xaf"),
        F.sum("nb_transactions").alias("nb_transactions"),
        F.sum("nb_clients_uniques").alias("nb_clients"),
        F.round(exact_mean("ca_moyen_par_transaction_xaf"), 0).alias("panier_moyen_xaf"),
    )
    # one row per month: bounded by the calendar
    before = F.lag("ca_mensuel_xaf").over(Window.orderBy("mois_annee"))
    out = per_month.withColumn("ca_mois_precedent_xaf", before)
    growth = F.col("ca_mensuel_xaf") - F.col("ca_mois_precedent_xaf")
    return out.withColumn("croissance_mois_pct", percent_of(growth, F.col("ca_mois_precedent_xaf")))
