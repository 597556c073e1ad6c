"""The registered queries: every operator over the star schema's whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from etalage import contracts as K
from etalage.functions import dates, numbers, rules, text
from etalage.operators import aggregates as A, clients as C, column_tests as CT, joins as J, marts as M
from etalage.operators import quality as Q, quantiles as QT, ranking as R, rows, staging as S, transactions as X
from etalage.plans import daily, stages
from etalage.plans.star import AMOUNT_MAX, AMOUNT_MIN, AS_OF, TX_ORDER, Star
from etalage.sinks import files as SF, service, warehouse as W
from etalage.sources import database as DB, extraction, feeds, files, increments
from etalage.storage import materialise, scratch_path
from etalage.streaming import increments as ST

REGISTRY: dict[str, Callable[[Star], DataFrame]] = {}

STAGED_TIES = ["produit_id", "magasin_id", "montant_total_xaf", "quantite"]
INGESTED_AT = dt.datetime(2002, 1, 1, 3, 0, 0)


def query(fn: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def present(df: DataFrame) -> DataFrame:
    """Output types that every SQL engine writes alike: bigint, double, boolean and text."""
    def plain(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            c = c.cast("long")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, " | ")
        return c.alias(field.name)

    return df.select(*[plain(field) for field in df.schema])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: present(fn(Star(spark, folder)))

    return {name: bind(fn) for name, fn in REGISTRY.items()}


def staged(star: Star) -> DataFrame:
    return S.stg_transactions(star.transactions(), AMOUNT_MIN, AMOUNT_MAX)


def staged_dimensions(star: Star) -> list[DataFrame]:
    """Clients, products and stores as written staging tables."""
    return [star.written(S.stg_clients(star.clients()), "stg_clients"),
            star.written(S.stg_products(star.products()), "stg_products"),
            star.written(S.stg_stores(star.stores(), AS_OF), "stg_stores")]


# ---------------------------------------------------------------------------------------------
# aggregates
# ---------------------------------------------------------------------------------------------

def enriched(star: Star, price: bool = False) -> DataFrame:
    """The fact with calendar columns and the store's name and town."""
    stores = star.written(star.stores(), "stores")
    return J.enrich_dimensions(X.time_dimensions(star.transactions(price=price)), stores=stores)


@query
def monthly_revenue(star: Star) -> DataFrame:
    return A.monthly_revenue(enriched(star))


@query
def top_products(star: Star) -> DataFrame:
    return A.top_products(star.transactions(), products=star.products())


@query
def product_sales(star: Star) -> DataFrame:
    return A.product_sales(star.transactions())


@query
def store_performance(star: Star) -> DataFrame:
    return A.store_performance(enriched(star))


@query
def rfm_quantile(star: Star) -> DataFrame:
    return A.rfm_quantile(star.transactions(price=False))


@query
def rfm_quantile_literal(star: Star) -> DataFrame:
    return A.rfm_quantile(star.transactions(price=False), orientation="literal")


@query
def segment_distribution(star: Star) -> DataFrame:
    rfm = materialise(A.rfm_quantile(star.transactions(price=False)).select("client_id", "segment_rfm"), "segments")
    return A.segment_distribution(rfm)


def aggregated_rows(star: Star, tx: DataFrame) -> DataFrame:
    """The fact with the store's name and town, in those columns that the four aggregates read which it has."""
    stores = star.written(star.stores(), "stores")
    return rows.column_slimming(J.enrich_dimensions(X.time_dimensions(tx), stores=stores), A.AGGREGATED_COLUMNS)


def aggregated_fact(star: Star, tx: DataFrame) -> DataFrame:
    """The same, written."""
    return star.written(aggregated_rows(star, tx), "transactions")


@query
def all_aggregates(star: Star) -> DataFrame:
    tx = aggregated_fact(star, star.transactions())
    rows_and_revenue = [df.agg(F.count(F.lit(1)).alias("nb_lignes"), F.sum("ca_total_xaf").alias("ca_total_xaf"))
                        .select(F.lit(name).alias("agregat"), "*") for name, df in A.all_aggregates(tx, star.products()).items()]
    return rows.union_aligned(*rows_and_revenue)


@query
def executive_dashboard(star: Star) -> DataFrame:
    return A.executive_dashboard(A.monthly_revenue(enriched(star)))


@query
def month_over_month(star: Star) -> DataFrame:
    return A.month_over_month(A.monthly_revenue(enriched(star)))


@query
def duplicate_count(star: Star) -> DataFrame:
    return rows.duplicate_count(star.transactions(price=False, order=False), ["transaction_id"])


@query
def quantiles_mean_std(star: Star) -> DataFrame:
    tx = star.transactions(price=False, order=False)
    amount = F.col("montant_total_xaf")
    q = QT.exact_quantiles(tx, "montant_total_xaf", [0.25, 0.5, 0.75]).scalar()
    moments = tx.agg(F.avg(amount.cast("double")).alias("m"), F.stddev_samp(amount.cast("double")).alias("s"))
    return moments.select(F.round(F.get(q, F.lit(0)), 4).alias("q1"), F.round(F.get(q, F.lit(1)), 4).alias("mediane"),
                          F.round(F.get(q, F.lit(2)), 4).alias("q3"), F.round("m", 4).alias("moyenne"),
                          F.round("s", 4).alias("ecart_type"))


# ---------------------------------------------------------------------------------------------
# windows, ranks, set operations
# ---------------------------------------------------------------------------------------------

@query
def dedup_transactions(star: Star) -> DataFrame:
    tx = star.transactions(price=False, order=False)
    return rows.dedup_latest(tx, ["transaction_id"], "date_transaction", STAGED_TIES)


@query
def keep_last(star: Star) -> DataFrame:
    return rows.keep_last(star.transactions(price=False, order=False), ["transaction_id"], TX_ORDER)


@query
def revenue_rank(star: Star) -> DataFrame:
    """Rank of products by volume, a value that many of them share."""
    sales = A.product_sales(star.transactions()).select("produit_id", "quantite_totale", "ca_total_xaf")
    return R.global_rank(sales, "quantite_totale", "produit_id", "rang_volume")


@query
def share_of_total(star: Star) -> DataFrame:
    sales = A.store_performance(star.transactions(price=False)).select("magasin_id", "ca_total_xaf")
    return R.share_of_total(sales, "ca_total_xaf", "part_ca_pct")


@query
def rfm_ntile(star: Star) -> DataFrame:
    return M.rfm_ntile(M.client_metrics(staged(star), AS_OF)).select(
        "client_id", "recence_jours", "nb_achats_total", "ca_total_xaf", "score_recence", "score_frequence",
        "score_montant", "score_rfm_moyen", "segment_rfm")


@query
def quantile_bins(star: Star) -> DataFrame:
    """Quintile bin of every order amount."""
    orders = star.table("orders").select("o_orderkey", F.col("o_totalprice").cast(K.MONEY).alias("montant"))
    edges = QT.exact_quantiles(orders, "montant", A.QUINTILES).scalar()
    return orders.select("o_orderkey", "montant",
                         QT.quantile_score(F.col("montant"), edges, 5, rising=True).alias("quintile"))


@query
def fixed_bins(star: Star) -> DataFrame:
    age = F.datediff(dates.day(AS_OF), F.col("date_inscription"))
    clients = star.clients().select("client_id", age.alias("anciennete_jours"))
    return clients.withColumn("segment_anciennete", C.tenure_segment(F.col("anciennete_jours")))


@query
def sort_output(star: Star) -> DataFrame:
    """Clients sorted by revenue, the largest first, with their position in the sorted files."""
    activity = A.client_activity(star.transactions(price=False)).select("client_id", "ca_total_xaf")
    sorted_ = rows.sort_output(activity, F.desc("ca_total_xaf"), F.asc("client_id"))
    # sorted partitions are numbered in order: the counts of those before give each its first position
    placed = materialise(sorted_.withColumn("__mid", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__mid", 33)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
              .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    within = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("__part", part).join(F.broadcast(starts), "__part")
            .select("client_id", "ca_total_xaf", (F.col("__start") + within + 1).alias("position")))


@query
def stage_parquet(star: Star) -> DataFrame:
    """The fact written as an intermediate stage, twice, and read back."""
    path = scratch_path(star.spark, "stage")
    for _ in range(2):
        SF.write_stage_parquet(star.transactions(price=False, order=False), path)
    return files.read_parquet_stage(star.spark, path).select("transaction_id", *TX_ORDER)


@query
def top_k(star: Star) -> DataFrame:
    tx = star.transactions(price=False, order=False).select(*TX_ORDER, "transaction_id")
    return rows.top_k(tx, 100, F.desc("montant_total_xaf"), "transaction_id", *TX_ORDER)


@query
def union_aligned(star: Star) -> DataFrame:
    """Rows with and without an address, and the stores, under the union of their columns."""
    clients = star.untidy_clients()
    return rows.union_aligned(
        clients.where(F.col("email").isNotNull()).select("client_id", "email", "ville"),
        clients.where(F.col("email").isNull()).select("client_id", "ville"),
        star.stores().select("magasin_id", "ville"))


@query
def key_set_difference(star: Star) -> DataFrame:
    """Stores that sell but are not active."""
    active = rows.status_is(star.stores(), "statut", K.ACTIVE)
    return rows.key_set_difference(star.transactions(price=False, order=False), active, "magasin_id")


# ---------------------------------------------------------------------------------------------
# filters and joins
# ---------------------------------------------------------------------------------------------

@query
def row_filters(star: Star) -> DataFrame:
    """Id, amount, quantity, status and membership filters one after the other."""
    tx = star.faulty_transactions()
    tx = rows.positive_quantity(rows.amount_range(rows.missing_id_filter(tx, "transaction_id"),
                                                  "montant_total_xaf", AMOUNT_MIN, AMOUNT_MAX))
    tx = rows.accepted_set(rows.status_is_not(tx, "statut", K.CANCELLED), "mode_paiement", K.PAYMENT_MODES)
    return tx.select("transaction_id", "montant_total_xaf", "quantite", "statut", "mode_paiement")


@query
def enrich_dimensions(star: Star) -> DataFrame:
    clients = star.written(C.enrich_clients(star.clients(), AS_OF), "clients")
    active = star.written(rows.status_is(star.stores(), "statut", K.ACTIVE), "stores")
    tx = J.enrich_dimensions(star.transactions(price=False), clients, star.products(), active)
    return tx.select("transaction_id", "client_id", "produit_id", "magasin_id", "montant_total_xaf",
                     "ville_client", "categorie_client", "sexe", "region", "nom_produit", "categorie_produit",
                     "sous_categorie", "nom_magasin", "ville_magasin")


@query
def sales_star_join(star: Star) -> DataFrame:
    joined = J.sales_star_join(staged(star), *staged_dimensions(star))
    return joined.select("transaction_id", "client_id", "produit_id", "magasin_id", "departement",
                         "est_client_premium", "segment_prix", "zone_commerciale", "taille_magasin")


@query
def orphan_keys(star: Star) -> DataFrame:
    active = rows.status_is(star.stores(), "statut", K.ACTIVE)
    return Q.orphan_keys(star.transactions(price=False), {"client_id": star.clients(),
                                                          "produit_id": star.products(), "magasin_id": active})


@query
def relationships_test(star: Star) -> DataFrame:
    active = rows.status_is(star.stores(), "statut", K.ACTIVE)
    broken = rows.broken_references(star.transactions(price=False, order=False), active, "magasin_id")
    return broken.groupBy("magasin_id").agg(F.count(F.lit(1)).alias("nb_lignes"))


# ---------------------------------------------------------------------------------------------
# cleaning
# ---------------------------------------------------------------------------------------------

@query
def amount_coherence(star: Star) -> DataFrame:
    tx = X.amount_coherence(star.faulty_transactions())
    return tx.select("transaction_id", *TX_ORDER[:3], "quantite", "montant_calcule_xaf", "ecart_montant_xaf",
                     "montant_coherent", "montant_total_xaf")


@query
def iqr_outliers(star: Star) -> DataFrame:
    orders = star.table("orders").select("o_orderkey", F.col("o_totalprice").cast(K.MONEY).alias("montant"))
    return QT.iqr_outliers(orders, "montant", k=0.5)


@query
def time_dimensions(star: Star) -> DataFrame:
    missing = F.col("o_orderkey") % 50 == 0
    orders = star.table("orders").select(
        "o_orderkey", F.when(~missing, F.col("o_orderdate").cast("date")).alias("date_transaction"))
    return X.time_dimensions(orders)


@query
def reject_routing(star: Star) -> DataFrame:
    routed = X.reject_routing(star.faulty_transactions(), TX_ORDER, AMOUNT_MIN, AMOUNT_MAX)
    return routed.select("transaction_id", *TX_ORDER, "motif_rejet")


@query
def clean_transactions(star: Star) -> DataFrame:
    clients = star.written(C.enrich_clients(star.clients(), AS_OF), "clients")
    valid, _ = X.clean_transactions(star.faulty_transactions(), TX_ORDER, clients, star.products(),
                                    star.written(star.stores(), "stores"), AMOUNT_MIN, AMOUNT_MAX)
    return valid.select("transaction_id", *TX_ORDER, "montant_coherent", "est_outlier", "mois_annee", "semaine",
                        "est_weekend", "nom_mois", "region", "categorie_produit", "ville_magasin")


@query
def rejected_transactions(star: Star) -> DataFrame:
    """Rejects by reason, through the CSV audit files."""
    _, rejected = X.clean_transactions(star.faulty_transactions(), TX_ORDER, lo=AMOUNT_MIN, hi=AMOUNT_MAX)
    path = scratch_path(star.spark, "rejets")
    SF.write_rejects(rejected, path, AS_OF)
    audit = star.spark.read.option("header", True).csv(path)
    return audit.groupBy(F.col("date_rejet").cast("string").alias("date_rejet"), "motif_rejet").agg(
        F.count(F.lit(1)).alias("nb_lignes"))


@query
def clean_clients(star: Star) -> DataFrame:
    return C.clean_clients(star.untidy_clients(), AS_OF, ["rang_arrivee"]).drop("quartier")


@query
def dedup_clients(star: Star) -> DataFrame:
    return C.dedup_clients(star.untidy_clients(), ["rang_arrivee"]).select("client_id", "email", "rang_arrivee")


@query
def map_codes(star: Star) -> DataFrame:
    raw = star.untidy_clients()
    return raw.select("rang_arrivee",
                      text.map_codes(F.col("ville"), K.CITY_ALIASES, F.col("ville")).alias("ville"),
                      text.map_codes(F.col("sexe"), K.SEX_CODES, "Inconnu").alias("sexe"),
                      text.map_codes(F.col("categorie"), K.CATEGORY_CODES, "Standard").alias("categorie"))


@query
def upper_name(star: Star) -> DataFrame:
    return star.untidy_clients().select("rang_arrivee", text.upper_name(F.col("nom")).alias("nom"))


@query
def hyphen_capitalize(star: Star) -> DataFrame:
    return star.untidy_clients().select("rang_arrivee", text.hyphen_capitalize(F.col("prenom")).alias("prenom"))


@query
def initcap_words(star: Star) -> DataFrame:
    """Every line of text of the benchmark and conversation tables, each word capitalised."""
    turns = star.table("conversations").select(F.concat_ws("/", "conv_id", "turn").alias("id"), "text")
    items = star.table("benchmark").select(F.col("item_id").cast("string").alias("id"), "text")
    return turns.unionByName(items).select("id", text.initcap_words(F.col("text")).alias("texte"))


def _found(star: Star, pattern: str) -> DataFrame:
    """All matches in the whole texts of the documents, with their position."""
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    return star.table("documents").select("doc_id", F.posexplode(found).alias("rang", "trouve"))


@query
def normalize_phone(star: Star) -> DataFrame:
    hits = _found(star, r"\+?[0-9][0-9 .()-]{6,}[0-9]")
    return hits.select("doc_id", "rang", "trouve", text.normalize_phone(F.col("trouve")).alias("telephone"),
                       text.valid_phone(F.col("trouve")).alias("est_valide"))


@query
def standardize_email(star: Star) -> DataFrame:
    hits = _found(star, r"[^\s<>()]+@[^\s<>()]+")
    return hits.select("doc_id", "rang", "trouve", text.standardize_email(F.col("trouve")).alias("email"),
                       text.valid_email(F.col("trouve")).alias("est_valide"))


# ---------------------------------------------------------------------------------------------
# staging and marts
# ---------------------------------------------------------------------------------------------

@query
def stg_clients(star: Star) -> DataFrame:
    return S.stg_clients(star.untidy_clients(), ["rang_arrivee"])


@query
def dim_clients(star: Star) -> DataFrame:
    return S.dim_clients(star.crm_clients())


@query
def stg_transactions(star: Star) -> DataFrame:
    return S.stg_transactions(star.faulty_transactions(), AMOUNT_MIN, AMOUNT_MAX)


@query
def stg_products(star: Star) -> DataFrame:
    return S.stg_products(star.products())


@query
def stg_stores(star: Star) -> DataFrame:
    return S.stg_stores(star.stores(), AS_OF)


@query
def sales_mart(star: Star) -> DataFrame:
    mart = M.sales_mart(staged(star), *staged_dimensions(star))
    return mart.withColumn("panier_moyen_xaf", numbers.round_half_up(F.col("panier_moyen_xaf"), 4))


@query
def client_metrics(star: Star) -> DataFrame:
    metrics = M.client_metrics(staged(star), AS_OF)
    return metrics.withColumn("panier_moyen_xaf", numbers.round_half_up(F.col("panier_moyen_xaf"), 4))


@query
def client_mart(star: Star) -> DataFrame:
    return M.client_mart(S.stg_clients(star.clients()), staged(star), AS_OF)


@query
def product_performance(star: Star) -> DataFrame:
    perf = M.product_performance(staged(star))
    return perf.withColumns({c: numbers.round_half_up(F.col(c), 4)
                             for c in ("ca_moyen_par_vente_xaf", "prix_moyen_observe_xaf")})


@query
def product_mart(star: Star) -> DataFrame:
    return M.product_mart(S.stg_products(star.products()), staged(star))


@query
def order_by_coalesce(star: Star) -> DataFrame:
    """Position of every product when the mart is sorted by its defaulted rank."""
    mart = M.product_mart(S.stg_products(star.products()), staged(star)).select("produit_id", "rang_ca")
    return R.global_row_number(mart, [F.asc("rang_ca"), F.asc("produit_id")], "position")


# ---------------------------------------------------------------------------------------------
# quality
# ---------------------------------------------------------------------------------------------

@query
def quality_report(star: Star) -> DataFrame:
    tx = star.faulty_transactions()
    copies = F.explode(F.when(F.col("quantite") == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    twice = materialise(tx.withColumn("copie", copies).drop("copie"), "transactions")
    return Q.quality_report(twice, "transactions", rules.transaction_rules(AMOUNT_MIN, AMOUNT_MAX))[0]


@query
def column_profile(star: Star) -> DataFrame:
    return Q.quality_report(star.faulty_transactions(), "transactions")[1]


@query
def validate_clients(star: Star) -> DataFrame:
    checked = rules.validate_rows(star.untidy_clients(), rules.client_rules())
    return checked.select("rang_arrivee", "est_valide", "erreurs")


@query
def validate_transactions(star: Star) -> DataFrame:
    checked = rules.validate_rows(star.faulty_transactions(), rules.transaction_rules(AMOUNT_MIN, AMOUNT_MAX))
    return checked.select("transaction_id", *TX_ORDER, "est_valide", "erreurs")


@query
def error_details(star: Star) -> DataFrame:
    """How often each message occurs among all invalid clients."""
    details = Q.error_details(star.untidy_clients(), rules.client_rules())
    return details.groupBy("erreur").agg(F.count(F.lit(1)).alias("nb"))


@query
def completeness_check(star: Star) -> DataFrame:
    return Q.completeness_check(star.untidy_clients().drop("ville"))


@query
def duplicate_check(star: Star) -> DataFrame:
    return Q.duplicate_check(star.transactions(price=False, order=False))


@query
def amount_anomalies(star: Star) -> DataFrame:
    orders = star.table("orders").select(F.col("o_totalprice").cast(K.MONEY).alias("montant_total_xaf"))
    return Q.amount_anomalies(orders, zmax=1.5)


def dimensions(star: Star) -> dict[str, DataFrame]:
    return {"client_id": star.clients(), "produit_id": star.products(),
            "magasin_id": rows.status_is(star.stores(), "statut", K.ACTIVE)}


@query
def referential_check(star: Star) -> DataFrame:
    return Q.referential_check(star.transactions(price=False), dimensions(star))


@query
def daily_volume(star: Star) -> DataFrame:
    return Q.daily_volume(star.table("events"), "ts", minimum=330)


@query
def daily_volume_check(star: Star) -> DataFrame:
    return Q.daily_volume_check(star.table("events"), "2024-01-16", "ts")


@query
def null_rate_alert(star: Star) -> DataFrame:
    return Q.null_rate_alert(star.faulty_transactions(), maximum=1.0, amounts=["quantite", "montant_total_xaf"],
                             date_bounds={"date_transaction": ("1996-01-01", "2000-12-31")})


@query
def quality_summary(star: Star) -> DataFrame:
    sources = star.sources() | {"magasins": rows.status_is(star.stores(), "statut", K.ACTIVE)}
    return daily.quality(sources, "2000-06-16")


@query
def column_tests(star: Star) -> DataFrame:
    tested = {t.table: CT.tested_columns(t.table, CT.MODEL_TESTS) for t in CT.MODEL_TESTS}
    models = daily.models(star.sources(), AS_OF, AMOUNT_MIN, AMOUNT_MAX, columns=tested)
    # the models write the staged tables; the marts are still to be written
    written = {name: materialise(df, name) if name in W.MART_TABLES else df for name, df in models.items()}
    return CT.run_column_tests(written)


@query
def table_constraints(star: Star) -> DataFrame:
    """The fact is written once, in the columns that are tested and those that the aggregates of tested columns read."""
    wanted = {t.table: CT.tested_columns(t.table, CT.TABLE_CONSTRAINTS) for t in CT.TABLE_CONSTRAINTS}
    fact = rows.column_slimming(star.transactions(), list(dict.fromkeys([*wanted["transactions"], *A.AGGREGATED_COLUMNS])))
    fact = star.written(fact, "fact")
    tables = star.sources() | A.all_aggregates(aggregated_rows(star, fact), star.products(), wanted)
    tested = {name: df.select(*wanted[name]) for name, df in tables.items() if name != "transactions"}
    tested = {name: materialise(df, name) for name, df in tested.items()}
    return CT.run_column_tests(tested | {"transactions": star.faulty_transactions(fact)}, CT.TABLE_CONSTRAINTS)


# ---------------------------------------------------------------------------------------------
# sources and sinks
# ---------------------------------------------------------------------------------------------

def _as_csv(df: DataFrame, tag: str) -> str:
    path = scratch_path(df.sparkSession, tag)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@query
def csv_transactions(star: Star) -> DataFrame:
    raw = star.faulty_transactions().withColumns({
        "quantite": F.when(F.col("quantite") == 3, "trois").otherwise(F.concat(F.lit(" "), "quantite", F.lit(".9"))),
        "date_transaction": F.when(F.col("quantite") == 4, "hier").otherwise(F.concat("date_transaction", F.lit(" 06:30:00"))),
    })
    return files.extract_transactions(star.spark, _as_csv(raw, "transactions"))


@query
def csv_clients(star: Star) -> DataFrame:
    path = _as_csv(star.untidy_clients(), "clients")
    return files.extract_clients(star.spark, path)


@query
def csv_produits(star: Star) -> DataFrame:
    return files.extract_produits(star.spark, _as_csv(star.products(), "produits"))


@query
def csv_magasins(star: Star) -> DataFrame:
    return files.extract_magasins(star.spark, _as_csv(star.stores(), "magasins"))


@query
def extract_reports(star: Star) -> DataFrame:
    """The four sources as CSV, read back as one bundle, with their quality summaries."""
    folder = scratch_path(star.spark, "raw")
    for name, df in (star.sources() | {"clients": star.untidy_clients()}).items():
        df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")
    return files.extract_reports(files.extract_all(star.spark, folder))


BRONZE_COLUMNS = ["transaction_id", "magasin_id", "produit_id", "quantite"]


def _untidy_csv(star: Star) -> str:
    """The fact as CSV lines, some of them with a field too many."""
    tx = star.transactions(price=False, order=False)
    line = F.concat_ws(",", *[F.col(c) for c in BRONZE_COLUMNS])
    torn = F.when(F.col("quantite") == 13, F.concat(line, F.lit(",?"))).otherwise(line)
    path = scratch_path(star.spark, "brut")
    # one column whose name is the header line; a separator that no line holds keeps it unquoted
    tx.select(torn.alias(",".join(BRONZE_COLUMNS))).write.option("header", True).option("sep", "\u0001").csv(path)
    return path


def _bronze_rows(bronze: DataFrame) -> DataFrame:
    """Good rows by their id, torn ones by their text."""
    good = F.col("etat") == SF.ACCEPTED
    return bronze.select(F.when(good, F.col("transaction_id")).otherwise(F.col(SF.CORRUPT)).alias("ligne"),
                         F.when(good, F.col("quantite")).alias("quantite"), "etat")


@query
def bronze_ingest(star: Star) -> DataFrame:
    path = scratch_path(star.spark, "bronze")
    for _ in range(2):  # a repeated run of the day replaces the day
        SF.bronze_ingest(star.spark, _untidy_csv(star), path, INGESTED_AT)
    return _bronze_rows(files.read_parquet_stage(star.spark, path))


@query
def bronze_stream(star: Star) -> DataFrame:
    """The same copy by a stream, run twice: the second run finds nothing new."""
    source = _untidy_csv(star)
    path, checkpoint = scratch_path(star.spark, "bronze"), scratch_path(star.spark, "checkpoint")
    for _ in range(2):
        ST.bronze_stream(star.spark, source, BRONZE_COLUMNS, path, checkpoint).awaitTermination()
    return _bronze_rows(star.spark.read.parquet(path))


def _erp(star: Star) -> tuple[DataFrame, DataFrame]:
    key = F.col("o_orderkey")
    status = F.get(F.array(*[F.lit(s) for s in ["Livré", "En cours", K.DELETED]]), (key % 4).cast("int"))
    orders = star.table("orders").select(
        F.concat(F.lit("CMD"), key).alias("commande_id"),
        F.col("o_orderdate").cast("date").alias("date_commande"),
        F.concat(F.lit("C"), "o_custkey").alias("client_id"),
        F.floor("o_totalprice").alias("montant_ht_xaf"),
        F.lit(K.VAT_PCT).alias("taux_tva"),
        F.when(key % 2 == 0, "Livraison domicile").otherwise("Retrait magasin").alias("mode_livraison"),
        status.alias("statut_commande"),
        (key % 1200).alias("vendeur_id"))
    sellers = star.table("supplier").select(F.col("s_suppkey").alias("vendeur_id"),
                                            F.col("s_name").alias("nom_commercial"))
    return orders, sellers


@query
def erp_orders(star: Star) -> DataFrame:
    return DB.erp_orders(*_erp(star), start="1996-01-01", end="1998-12-31")


def _prices(star: Star) -> DataFrame:
    line = star.table("lineitem").join(star.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    reason = F.get(F.array(*[F.lit(r) for r in ["Promotion", "Fin promotion"]]), F.col("l_linenumber") % 3)
    return line.select(
        F.concat(F.lit("P"), "l_partkey").alias("produit_id"),
        F.floor("p_retailprice").alias("ancien_prix_xaf"),
        F.floor("l_extendedprice").alias("nouveau_prix_xaf"),
        F.when(F.col("l_linenumber") != 6, F.col("l_shipdate").cast("date")).alias("date_changement"),
        F.coalesce(reason, F.lit("Révision tarifaire")).alias("motif_changement"),
        F.concat(F.lit("T"), "l_orderkey", F.lit("-"), "l_linenumber").alias("operateur_id"))


@query
def price_history(star: Star) -> DataFrame:
    """Price changes with their position in the report's order."""
    ties = [F.asc("operateur_id"), F.asc("nouveau_prix_xaf"), F.asc("ancien_prix_xaf")]
    return R.global_row_number(DB.price_history(_prices(star)), DB.price_history_order() + ties, "position")


def _as_json(df: DataFrame, tag: str, schema: T.StructType) -> DataFrame:
    path = scratch_path(df.sparkSession, tag)
    df.write.json(path)
    return feeds.read_landed_json(df.sparkSession, path, schema)


@query
def price_snapshot(star: Star) -> DataFrame:
    """Dearest sale of each product against the catalogue, which knows some of them under another id."""
    landed = star.table("lineitem").groupBy("l_partkey").agg(
        F.floor(F.max("l_extendedprice")).alias("prix_actuel_xaf"), F.max("l_shipdate").alias("date_maj_prix"))
    letter = F.when(F.col("l_partkey") % 13 == 0, "N").otherwise("P")
    landed = landed.select(F.concat(letter, "l_partkey").alias("produit_id"), "prix_actuel_xaf", "date_maj_prix")
    return feeds.price_snapshot(_as_json(landed, "prix", K.PRICE_FEED), star.products())


@query
def fx_pairs(star: Star) -> DataFrame:
    """A quote per event, its type standing for the target currency."""
    landed = star.table("events").select(
        F.concat(F.lit("XAF_"), F.upper("event_type")).alias("paire"),
        F.col("value").alias("taux"), F.col("ts").cast("date").alias("date"))
    return feeds.fx_pairs(_as_json(landed, "taux", K.FX_FEED))


@query
def events_in_range(star: Star) -> DataFrame:
    calendar = star.table("events").select(
        "event_id", F.col("ts").cast("date").alias("date"), F.col("event_type").alias("type"),
        F.col("value").alias("impact_ventes_pct"), F.lit("Toutes").alias("villes_concernees"))
    return feeds.events_in_range(calendar, "2024-01-05", "2024-01-20")


def _stock(star: Star) -> DataFrame:
    landed = star.table("lineitem").groupBy("l_suppkey", "l_partkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("quantite_stock"), F.max("l_shipdate").alias("date_releve"))
    landed = landed.select(F.concat(F.lit("M"), "l_suppkey").alias("magasin_id"),
                           F.concat(F.lit("P"), "l_partkey").alias("produit_id"), "quantite_stock", "date_releve")
    active = rows.status_is(star.stores(), "statut", K.ACTIVE)
    return feeds.stock_levels(_as_json(landed, "stocks", K.STOCK_FEED), active, star.products())


@query
def stock_alerts(star: Star) -> DataFrame:
    return _stock(star)


@query
def stockout_rate(star: Star) -> DataFrame:
    return Q.stockout_rate(_stock(star))


@query
def incremental_extract(star: Star) -> DataFrame:
    """Two extractions: what the second takes after the mark of the first, and a table never seen before."""
    events = star.table("events").withColumnRenamed("ts", "date_maj")
    first = events.where(F.col("date_maj") < F.lit("2024-01-20").cast("timestamp_ntz"))
    marks = materialise(increments.next_mark(first, "ventes"), "marques")
    delta = increments.incremental_extract(events, marks, "ventes")
    full = increments.incremental_extract(events, marks, "stocks")
    columns = ["event_id", "date_maj", "event_type", "value"]
    return delta.select(F.lit("ventes").alias("source"), *columns).unionByName(
        full.select(F.lit("stocks").alias("source"), *columns))


@query
def upsert_table(star: Star) -> DataFrame:
    """Load orders, then merge later versions of some of them together with new ones, twice."""
    root = scratch_path(star.spark, "warehouse")
    line = star.transactions(price=False, order=False).select("transaction_id", *TX_ORDER)
    early = F.lit("2000-01-01").cast("date")
    first = rows.keep_last(line.where(F.col("date_transaction") < early), ["transaction_id"], TX_ORDER)
    W.load_table(first, root, "staging.ventes", run_id="1")
    for run in ("2", "3"):
        W.load_table(line.where(F.col("date_transaction") >= early), root, "staging.ventes", W.UPSERT,
                     ["transaction_id"], TX_ORDER, run_id=run)
    return W.read_table(star.spark, root, "staging.ventes")


@query
def upsert_stream(star: Star) -> DataFrame:
    """The same merge fed by files as they arrive."""
    line = star.transactions(price=False, order=False).select("transaction_id", *TX_ORDER)
    arrivals, root = scratch_path(star.spark, "arrivees"), scratch_path(star.spark, "warehouse")
    line.write.parquet(arrivals)
    ST.upsert_stream(star.spark, arrivals, line.schema, root, "staging.ventes", ["transaction_id"], TX_ORDER,
                     scratch_path(star.spark, "checkpoint")).awaitTermination()
    return W.read_table(star.spark, root, "staging.ventes")


@query
def daily_volume_stream(star: Star) -> DataFrame:
    """Rows of every day of the event stream."""
    spark, root = star.spark, scratch_path(star.spark, "warehouse")
    events = spark.readStream.schema(star.table("events").schema).parquet(f"{star.folder}/events.parquet*")
    ST.daily_volume_table(events, "ts", root, "staging.volumes", scratch_path(spark, "checkpoint")).awaitTermination()
    return W.read_table(spark, root, "staging.volumes")


@query
def upsert_partitions(star: Star) -> DataFrame:
    """All sales by month, then corrected online sales merged in: their months alone are rewritten."""
    path = scratch_path(star.spark, "faits")
    key = ["transaction_id", "annee", "mois"]
    line = X.time_dimensions(star.transactions(price=False, order=False)).select("transaction_id", *TX_ORDER,
                                                                                 "canal_vente", "annee", "mois")
    SF.partitioned_fact(rows.keep_last(line, key, TX_ORDER), path)
    updates = rows.keep_last(line.where(F.col("canal_vente") == K.ONLINE), key, TX_ORDER)
    updates = updates.withColumn("quantite", F.col("quantite") + 1)
    SF.upsert_partitions(materialise(updates, "updates"), path, key)
    return star.spark.read.schema(line.schema).parquet(path)


def _loaded(star: Star) -> str:
    root = scratch_path(star.spark, "warehouse")
    W.staging_loads(star.sources(), root, run_id="soir")
    # the aggregates are made from the table that has been loaded, so the fact is joined and written once
    tx = W.read_table(star.spark, root, "staging.transactions")
    stores = star.written(star.stores(), "stores")
    if rows.duplicate_count(stores.where("magasin_id IS NOT NULL"), ["magasin_id"]).first()["nb_doublons"]:
        tx, stores = aggregated_fact(star, tx), None  # a store that stands twice counts its sales twice in all four
    W.mart_loads(A.all_aggregates(tx, star.products(), stores=stores), root, run_id="soir")
    W.load_table(star.stores(), root, "staging.magasins", W.APPEND, run_id="soir")
    W.load_table(star.clients().where("false"), root, "staging.clients", W.APPEND, run_id="soir")
    return root


def _extractions(star: Star) -> DataFrame:
    """The journal after two runs: the sources, what is new in one of them, and a feed that has not arrived."""
    root = scratch_path(star.spark, "warehouse")
    events = star.table("events").withColumnRenamed("ts", "date_maj")
    first = events.where(F.col("date_maj") < F.lit("2024-01-20").cast("timestamp_ntz"))
    marks = materialise(increments.next_mark(first, "ventes"), "marques")
    sources = [extraction.Source(name, lambda df=df: df) for name, df in star.sources().items()]
    feeds_ = [extraction.Source("ventes", lambda: increments.incremental_extract(events, marks, "ventes"), extraction.DELTA),
              extraction.Source("taux", lambda: files.read_csv_text(star.spark, f"{root}/taux.csv"), optional=True)]
    for run, wanted in {"soir": sources + feeds_, "nuit": feeds_}.items():
        for source in wanted:
            extraction.extract(star.spark, source, f"{root}/extraits/{run}/{source.name}", root, run, pause=0)
    return extraction.read_extractions(star.spark, root)


@query
def extraction_journal(star: Star) -> DataFrame:
    return _extractions(star).select("source", "mode", "nb_lignes", "nb_tentatives", "statut", "pipeline_run_id")


@query
def extraction_report(star: Star) -> DataFrame:
    return extraction.extraction_report(_extractions(star)).drop("duree_max_secondes", "dernier_succes")


@query
def pipeline_runs(star: Star) -> DataFrame:
    return service.pipeline_runs(star.journal())


@query
def success_rate(star: Star) -> DataFrame:
    return service.success_rate(service.pipeline_runs(star.journal()), minimum=95.0)


@query
def availability(star: Star) -> DataFrame:
    runs = materialise(service.pipeline_runs(star.journal()).select("jour", "statut"), "runs")
    return service.availability(runs)


@query
def load_journal(star: Star) -> DataFrame:
    journal = W.read_journal(star.spark, _loaded(star))
    return journal.select("table_cible", "nb_lignes_source", "nb_lignes_inserees", "nb_lignes_mises_a_jour",
                          "nb_lignes_rejetees", "strategie", "statut", "pipeline_run_id")


@query
def load_report(star: Star) -> DataFrame:
    return W.load_report(W.read_journal(star.spark, _loaded(star)))


@query
def load_summary(star: Star) -> DataFrame:
    return W.pipeline_summary(W.read_journal(star.spark, _loaded(star)))


@query
def append_table(star: Star) -> DataFrame:
    """Rows per store after a replace and an append."""
    return (W.read_table(star.spark, _loaded(star), "staging.magasins")
             .groupBy("magasin_id").agg(F.count(F.lit(1)).alias("nb")))


@query
def partitioned_fact(star: Star) -> DataFrame:
    """The fact by year and month; the months of 1998 are then written again from half of the stores."""
    path = scratch_path(star.spark, "faits")
    tx = X.time_dimensions(star.transactions(price=False, order=False))
    SF.partitioned_fact(tx, path)
    again = tx.where((F.col("annee") == 1998) & (F.col("canal_vente") == K.ONLINE))
    SF.partitioned_fact(again, path)
    return star.spark.read.parquet(path).groupBy("annee", "mois").agg(
        F.count(F.lit(1)).alias("nb_lignes"), F.sum("montant_total_xaf").alias("ca_total_xaf"))


@query
def daily_run(star: Star) -> DataFrame:
    """The whole run into a warehouse: rows per table as the journal reports them."""
    root = scratch_path(star.spark, "warehouse")
    order = daily.ArrivalOrder(["rang_arrivee"], TX_ORDER)
    sources = star.sources() | {"clients": star.untidy_clients(), "transactions": star.faulty_transactions()}
    _, report = daily.run(sources, root, "nuit", AS_OF, order, AMOUNT_MIN, AMOUNT_MAX)
    return report.select("table_cible", "nb_lignes_inserees", "nb_lignes_rejetees", "statut")


@query
def staged_run(star: Star) -> DataFrame:
    """The run in stages, stopped after the models and taken up again: rows per stage and table."""
    root = scratch_path(star.spark, "warehouse")
    sources = star.sources() | {"clients": star.untidy_clients(), "transactions": star.faulty_transactions()}
    run = stages.StagedRun(star.spark, root, "nuit", AS_OF, daily.ArrivalOrder(["rang_arrivee"], TX_ORDER), AMOUNT_MIN, AMOUNT_MAX)
    run.run(sources, [stages.EXTRACT, stages.TRANSFORM, stages.MODELS])
    return run.run({}).select("etape", "nom_table", "nb_lignes", "statut")
