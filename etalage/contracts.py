"""Declared schemas, thresholds, code lists and messages of the retail model.

Operators take these as defaults; pass other values to use another catalogue.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Source columns.  Kinds: text (stripped), int (invalid -> 0), money
# (invalid -> null), date (invalid -> null).
# --------------------------------------------------------------------------------------

CLIENTS = {
    "client_id": "text",
    "nom": "text",
    "prenom": "text",
    "email": "text",
    "telephone": "text",
    "ville": "text",
    "quartier": "text",
    "date_inscription": "text",
    "sexe": "text",
    "categorie": "text",
}

TRANSACTIONS = {
    "transaction_id": "text",
    "date_transaction": "time",
    "client_id": "text",
    "magasin_id": "text",
    "produit_id": "text",
    "quantite": "int",
    "prix_unitaire_xaf": "money",
    "montant_total_xaf": "money",
    "mode_paiement": "text",
    "statut": "text",
    "canal_vente": "text",
}

PRODUITS = {
    "produit_id": "text",
    "nom_produit": "text",
    "categorie": "text",
    "sous_categorie": "text",
    "prix_unitaire_xaf": "money",
    "stock_initial": "int",
    "fournisseur": "text",
    "pays_origine": "text",
}

MAGASINS = {
    "magasin_id": "text",
    "nom_magasin": "text",
    "ville": "text",
    "quartier": "text",
    "adresse": "text",
    "responsable": "text",
    "telephone": "text",
    "surface_m2": "int",
    "date_ouverture": "date",
    "statut": "text",
}

MONEY = T.DecimalType(15, 2)
MONEY_SUM = T.DecimalType(18, 2)
PERCENT = T.DecimalType(6, 2)


@dataclass(frozen=True)
class TableContract:
    """A source table: its name and the kind of each required column."""

    name: str
    columns: dict[str, str]


CSV_CONTRACTS = {
    "clients": TableContract("clients", CLIENTS),
    "transactions": TableContract("transactions", TRANSACTIONS),
    "produits": TableContract("produits", PRODUITS),
    "magasins": TableContract("magasins", MAGASINS),
}

# Schemas of the landed feeds.

PRICE_FEED = T.StructType([
    T.StructField("produit_id", T.StringType()),
    T.StructField("prix_actuel_xaf", T.LongType()),
    T.StructField("date_maj_prix", T.TimestampNTZType()),
])

FX_FEED = T.StructType([
    T.StructField("paire", T.StringType()),
    T.StructField("taux", T.DoubleType()),
    T.StructField("date", T.DateType()),
])

STOCK_FEED = T.StructType([
    T.StructField("magasin_id", T.StringType()),
    T.StructField("produit_id", T.StringType()),
    T.StructField("quantite_stock", T.LongType()),
    T.StructField("date_releve", T.TimestampNTZType()),
])

JOURNAL = T.StructType([
    T.StructField("table_cible", T.StringType()),
    T.StructField("nb_lignes_source", T.LongType()),
    T.StructField("nb_lignes_inserees", T.LongType()),
    T.StructField("nb_lignes_mises_a_jour", T.LongType()),
    T.StructField("nb_lignes_rejetees", T.LongType()),
    T.StructField("strategie", T.StringType()),
    T.StructField("statut", T.StringType()),
    T.StructField("erreur", T.StringType()),
    T.StructField("emplacement", T.StringType()),
    T.StructField("morceaux", T.ArrayType(T.StringType())),
    T.StructField("remplace", T.ArrayType(T.StringType())),
    T.StructField("debut_chargement", T.TimestampNTZType()),
    T.StructField("fin_chargement", T.TimestampNTZType()),
    T.StructField("duree_secondes", T.DecimalType(10, 2)),
    T.StructField("pipeline_run_id", T.StringType()),
    T.StructField("date_execution", T.DateType()),
])

EXTRACTIONS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("nb_lignes", T.LongType()),
    T.StructField("nb_tentatives", T.LongType()),
    T.StructField("statut", T.StringType()),
    T.StructField("erreur", T.StringType()),
    T.StructField("emplacement", T.StringType()),
    T.StructField("debut_extraction", T.TimestampNTZType()),
    T.StructField("fin_extraction", T.TimestampNTZType()),
    T.StructField("duree_secondes", T.DecimalType(10, 2)),
    T.StructField("pipeline_run_id", T.StringType()),
])

# --------------------------------------------------------------------------------------
# thresholds
# --------------------------------------------------------------------------------------

AMOUNT_MIN = 500
AMOUNT_MAX = 5_000_000
AMOUNT_TOLERANCE = 1
IQR_FACTOR = 1.5
ZSCORE_MAX = 3
COMPLETENESS_MIN_PCT = 95.0
DUPLICATES_MAX_PCT = 1.0
NULL_RATE_MAX_PCT = 5.0
DAILY_ROWS_MIN = 1
LOW_STOCK = 10
STOCKOUT_MAX_PCT = 10
STORE_MONTHS = 24
DEFAULT_PRICE = 50_000
VAT_PCT = 18.0
TOP_N = 20
PERIOD_START = "2024-01-01"
PERIOD_END = "2025-12-31"
EXTRACTION_ATTEMPTS = 3
EXTRACTION_PAUSE_SECONDS = 5.0
RUN_DUE_SECONDS = 6 * 3600
RUN_MAX_SECONDS = 2 * 3600
SUCCESS_DAYS = 30
SUCCESS_MIN_PCT = 98.0
AVAILABILITY_MIN_PCT = 99.0

# --------------------------------------------------------------------------------------
# Code lists
# --------------------------------------------------------------------------------------

CITY_ALIASES = {
    "brazzaville": "Brazzaville",
    "brazza": "Brazzaville",
    "bzv": "Brazzaville",
    "pointe-noire": "Pointe-Noire",
    "pointenoire": "Pointe-Noire",
    "pnr": "Pointe-Noire",
    "dolisie": "Dolisie",
    "loubomo": "Dolisie",
    "ouesso": "Ouesso",
    "nkayi": "Nkayi",
    "impfondo": "Impfondo",
}

SEX_CODES = {
    "m": "M",
    "h": "M",
    "homme": "M",
    "masculin": "M",
    "f": "F",
    "femme": "F",
    "féminin": "F",
    "feminin": "F",
}

CATEGORY_CODES = {
    "standard": "Standard",
    "std": "Standard",
    "normal": "Standard",
    "premium": "Premium",
    "prem": "Premium",
    "vip": "VIP",
    "very important": "VIP",
}

REGION_BY_CITY = {
    "Brazzaville": "Pool",
    "Pointe-Noire": "Kouilou",
    "Dolisie": "Niari",
    "Ouesso": "Sangha",
    "Nkayi": "Bouenza",
    "Impfondo": "Likouala",
}

ZONE_BY_CITY = {
    "Brazzaville": "Zone Nord",
    "Pointe-Noire": "Zone Océan",
    "Dolisie": "Zone Sud",
    "Ouesso": "Zone Nord",
}

SEX_LABELS = {"M": "Masculin", "F": "Féminin"}

MONTH_NAMES = [
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
]

VALID_CITIES = [
    "Brazzaville", "Pointe-Noire", "Dolisie", "Ouesso",
    "Nkayi", "Impfondo", "Sibiti", "Madingou", "Kinkala",
]

PAYMENT_MODES = ["Espèces", "Mobile Money", "Carte bancaire", "Virement"]
CLIENT_CATEGORIES = ["Standard", "Premium", "VIP"]
PREMIUM_CATEGORIES = ["Premium", "VIP"]
TRANSACTION_STATUSES = ["Validé", "Annulé", "En attente", "Remboursé"]
LOCAL_COUNTRIES = ["Congo", "Congo-Brazzaville", "RDC"]
COUNTRY_CODES = {
    "congo": "CG", "congo-brazzaville": "CG", "république du congo": "CG", "rdc": "CD", "cameroun": "CM", "gabon": "GA",
    "tchad": "TD", "centrafrique": "CF", "république centrafricaine": "CF", "guinée équatoriale": "GQ", "angola": "AO",
    "chine": "CN", "france": "FR",
}
CRITICAL_CLIENT_COLUMNS = ["client_id", "nom", "email", "ville"]

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^(\+242)?0[456]\p{Nd}{7,8}$"

# labels

REASON_MISSING_ID = "transaction_id manquant"
REASON_AMOUNT = "Montant hors plage acceptable"
REASON_QUANTITY = "Quantité nulle ou négative"

CANCELLED = "Annulé"
DELETED = "Supprimé"
ACTIVE = "Actif"
ONLINE = "En ligne"

STATUS_OK = "OK"
STATUS_ALERT = "ALERTE"
STATUS_NOT_RUN = "NON EXÉCUTÉ"

# The origin that extracts are marked with.
SOURCE_FX = "API_BEAC_SIMULEE"
SOURCE_ERP = "ERP_INTERNE"

# Texts that a CSV cell may hold for "no value" (the defaults of the usual CSV readers).
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
