"""Typed, trimmed and labelled staging views of the four source tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from etalage import contracts as K
from etalage.functions import dates
from etalage.functions.text import initcap_words, lookup, map_codes
from etalage.operators.rows import amount_range, dedup_latest, missing_id_filter, positive_quantity, status_is, \
    status_is_not

# Amount, price and size classes, highest bound first.
AMOUNT_CLASSES = [(200_000, "Grande transaction"), (50_000, "Transaction moyenne")]
AMOUNT_CLASS_LOW = "Petite transaction"
PRICE_CLASSES = [(300_000, "Prix élevé"), (50_000, "Prix moyen"), (10_000, "Prix abordable")]
PRICE_CLASS_LOW = "Bas prix"
SIZE_CLASSES = [(600, "Grand"), (350, "Moyen")]
SIZE_CLASS_LOW = "Petit"


def classify(value: Column, classes: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Label of the highest bound that a value reaches; ``lowest`` below all of them and for null."""
    chain = F.when(value >= classes[0][0], classes[0][1])
    for bound, label in classes[1:]:
        chain = chain.when(value >= bound, label)
    return chain.otherwise(lowest)


def _trimmed(*names: str) -> dict[str, Column]:
    return {name: F.trim(F.col(name)) for name in names}


def _titled(*names: str) -> dict[str, Column]:
    return {name: initcap_words(F.trim(F.col(name))) for name in names}


def stg_clients(df: DataFrame, tiebreak: Sequence[str] = ("client_id",)) -> DataFrame:
    """Clients with an id and a name, one row per id: the one with the latest registration."""
    kept = missing_id_filter(df, "client_id", "nom")
    first_name = initcap_words(F.trim("prenom"))
    sex, category = F.upper(F.trim("sexe")), F.trim("categorie")
    shaped = {
        **_trimmed("client_id", "telephone"),
        **_titled("ville", "quartier"),
        "prenom": first_name,
        "nom_complet": F.concat(F.trim("nom"), F.lit(" "), first_name),
        "nom": F.upper(F.trim("nom")),
        "email": F.lower(F.trim("email")),
        "sexe": sex,
        "sexe_libelle": F.coalesce(lookup(sex, K.SEX_LABELS), F.lit("Non renseigné")),
        "departement": F.coalesce(lookup(F.trim("ville"), K.REGION_BY_CITY), F.lit("Autre")),
        "categorie_client": category,
        "est_client_premium": F.coalesce(category.isin(*K.PREMIUM_CATEGORIES), F.lit(False)),
        "date_inscription": dates.to_day(F.col("date_inscription")),
    }
    # the tiebreak reads source columns, so they travel beside the shaped ones until the choice is made
    ties = [f"__tie{i}" for i in range(len(tiebreak))]
    both = kept.select(*[column.alias(name) for name, column in shaped.items()],
                       *[F.col(c).alias(t) for c, t in zip(tiebreak, ties)])
    return dedup_latest(both, ["client_id"], "date_inscription", ties).drop(*ties)


def dim_clients(df: DataFrame, countries: Mapping[str, str] = K.COUNTRY_CODES) -> DataFrame:
    """The customer system's clients as a dimension: names in title case, country codes, checked addresses.

    Countries written out become their codes; any other text is taken for a code and put in upper case.  An
    address that is malformed or padded, and a date that cannot be read, become null.  Rows without an id go.
    """
    # the end of the text, not the end of its last line
    address = F.col("email").rlike(K.EMAIL_PATTERN.removesuffix("$") + r"\z")
    return df.where(F.col("id_client").isNotNull()).select(
        "id_client",
        *[column.alias(name) for name, column in _titled("nom").items()],
        map_codes(F.col("code_pays"), countries, F.upper(F.trim("code_pays"))).alias("code_pays"),
        *[column.alias(name) for name, column in _titled("ville").items()],
        F.when(address, F.col("email")).alias("email_valide"),
        dates.to_day(F.col("date_creation")).alias("date_creation"),
    )


def stg_transactions(df: DataFrame, lo: float = K.AMOUNT_MIN, hi: float = K.AMOUNT_MAX,
                     tiebreak: Sequence[str] = ("produit_id", "magasin_id", "montant_total_xaf", "quantite")
                     ) -> DataFrame:
    """Valid, uncancelled transactions, one row per id: the latest."""
    typed = df.withColumns({"date_transaction": dates.to_day(F.col("date_transaction")),
                            "quantite": F.col("quantite").cast("bigint"),
                            "prix_unitaire_xaf": F.col("prix_unitaire_xaf").cast(K.MONEY),
                            "montant_total_xaf": F.col("montant_total_xaf").cast(K.MONEY)})
    kept = missing_id_filter(typed, "transaction_id").where(F.col("date_transaction").isNotNull())
    kept = positive_quantity(amount_range(kept, "montant_total_xaf", lo, hi))
    kept = status_is_not(kept, "statut", K.CANCELLED)
    kept = dedup_latest(kept.withColumn("transaction_id", F.trim("transaction_id")),
                        ["transaction_id"], "date_transaction", tiebreak)
    d, total, channel = F.col("date_transaction"), F.col("montant_total_xaf"), F.trim("canal_vente")
    return kept.select(
        "transaction_id",
        *[column.alias(name) for name, column in _trimmed("client_id", "magasin_id", "produit_id").items()],
        d,
        F.year(d).alias("annee"),
        F.month(d).alias("mois"),
        F.quarter(d).alias("trimestre"),
        dates.month_key(d).alias("mois_annee"),
        dates.month_name(d).alias("nom_mois"),
        dates.day_name(d).alias("jour_semaine"),
        "quantite",
        "prix_unitaire_xaf",
        "montant_total_xaf",
        (F.col("quantite").cast("decimal(19,0)") * F.col("prix_unitaire_xaf")).alias("montant_recalcule_xaf"),
        F.trim("mode_paiement").alias("mode_paiement"),
        F.trim("statut").alias("statut_transaction"),
        channel.alias("canal_vente"),
        F.coalesce(channel == K.ONLINE, F.lit(False)).alias("est_vente_en_ligne"),
        classify(total, AMOUNT_CLASSES, AMOUNT_CLASS_LOW).alias("segment_montant"),
    )


def stg_products(df: DataFrame) -> DataFrame:
    """Products with an id, a local flag and a price class."""
    price = F.col("prix_unitaire_xaf").cast(K.MONEY)
    shaped = {
        **_trimmed("produit_id", "nom_produit"),
        **_titled("categorie", "sous_categorie"),
        "prix_unitaire_xaf": price,
        "stock_initial": F.col("stock_initial").cast("bigint"),
        **_trimmed("fournisseur", "pays_origine"),
        "est_produit_local": F.coalesce(F.trim("pays_origine").isin(*K.LOCAL_COUNTRIES), F.lit(False)),
        "segment_prix": classify(price, PRICE_CLASSES, PRICE_CLASS_LOW),
    }
    return missing_id_filter(df, "produit_id").select(*[c.alias(name) for name, c in shaped.items()])


def stg_stores(df: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Active stores with zone, size class and age in whole years."""
    surface, opened = F.col("surface_m2").cast("bigint"), dates.to_day(F.col("date_ouverture"))
    shaped = {
        **_trimmed("magasin_id", "nom_magasin"),
        **_titled("ville", "quartier"),
        **_trimmed("adresse", "responsable", "telephone"),
        "surface_m2": surface,
        "date_ouverture": opened,
        "statut": F.trim("statut"),
        "zone_commerciale": F.coalesce(lookup(F.trim("ville"), K.ZONE_BY_CITY), F.lit("Autre zone")),
        "taille_magasin": classify(surface, SIZE_CLASSES, SIZE_CLASS_LOW),
        "anciennete_annees": dates.whole_years(opened, dates.day(as_of)),
    }
    active = status_is(missing_id_filter(df, "magasin_id"), "statut", K.ACTIVE)
    return active.select(*[c.alias(name) for name, c in shaped.items()])
