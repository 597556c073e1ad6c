"""The daily run: extract, clean, aggregate, load; and the staging and mart models over its tables."""

from __future__ import annotations

import contextvars
import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from etalage import contracts as K
from etalage.operators.aggregates import all_aggregates, executive_dashboard, month_over_month
from etalage.operators.clients import clean_clients
from etalage.operators.marts import CLIENT_COLUMNS, FACT_COLUMNS, client_mart, product_mart, sales_mart
from etalage.operators.quality import amount_anomalies, completeness_check, daily_volume_check, duplicate_check, \
    quality_summary, referential_check
from etalage.operators.rows import sort_output
from etalage.operators.staging import stg_clients, stg_products, stg_stores, stg_transactions
from etalage.operators.transactions import clean_transactions
from etalage.sinks.files import write_rejects
from etalage.sinks.warehouse import MART_TABLES, STAGING_TABLES, UPSERT, Piece, drop_pieces, load_all, load_table, \
    read_table, table_of, write_piece
from etalage.sources.increments import incremental_extract, next_mark
from etalage.storage import materialise, scratch


# The order in which each table is put out.
OUTPUT_ORDER = {
    "clients": ["client_id asc nulls last"],
    "transactions": ["date_transaction asc nulls last"],
    "ca_mensuel": ["annee asc", "mois asc", "ca_total_xaf desc"],
    "top_produits": ["ca_total_xaf desc"],
    "performance_magasins": ["ca_total_xaf desc"],
    "segmentation_rfm": ["score_RFM desc"],
    "mart_ventes": ["annee asc", "mois asc", "ca_total_xaf desc"],
    "mart_clients": ["ca_total_xaf desc"],
    "mart_produits": ["rang_ca asc"],
    "v_evolution_ca": ["mois_annee asc"],
}


def ordered(name: str, df: DataFrame) -> DataFrame:
    """A table in its output order, for a reader who wants it sorted; loads do not sort."""
    return sort_output(df, *[_sort_column(*term.split(maxsplit=1)) for term in OUTPUT_ORDER[name]])


def _sort_column(column: str, direction: str) -> Column:
    return {"asc": F.asc, "desc": F.desc, "asc nulls last": F.asc_nulls_last}[direction](column)


@dataclass(frozen=True)
class ArrivalOrder:
    """Columns that give each source its row order, for "the last row wins"."""

    clients: Sequence[str]
    transactions: Sequence[str]


def transform(sources: Mapping[str, DataFrame], as_of: str | dt.date, order: ArrivalOrder,
              lo: float = K.AMOUNT_MIN, hi: float = K.AMOUNT_MAX,
              write: Callable[[DataFrame, str], DataFrame] = materialise) -> dict[str, DataFrame]:
    """Cleaned sources, rejects and the four aggregates, by table name.  Absent sources are left out.

    ``write`` writes a table that others are made from and reads it back; whoever keeps the tables gives the place.
    What the cleaning wrote for itself is deleted when its two results are written.
    """
    # written, so that Spark knows their size when it joins them
    out: dict[str, DataFrame] = {name: write(sources[name], name) for name in ("produits", "magasins") if name in sources}
    if "clients" in sources:
        out["clients"] = write(clean_clients(sources["clients"], as_of, order.clients), "clients")
    if "transactions" in sources:
        outside = contextvars.copy_context()
        with scratch(sources["transactions"].sparkSession):
            valid, rejected = clean_transactions(sources["transactions"], order.transactions, out.get("clients"),
                                                 out.get("produits"), out.get("magasins"), lo, hi)
            # five loads read the cleaned fact: it is joined and written once
            out["transactions"] = outside.run(write, valid, "transactions")
            out["transactions_rejetees"] = outside.run(write, rejected, "transactions_rejetees")
        out |= all_aggregates(out["transactions"], out.get("produits"))
    return out


def load(tables: Mapping[str, DataFrame], root: str, run_id: str, rejected: Mapping[str, int] | None = None,
         pieces: Mapping[str, Piece] | None = None) -> tuple[bool, DataFrame | None]:
    """Load the staging and mart tables among ``tables``; ``pieces``, by name, are written in the warehouse already."""
    staging = {name: df for name, df in tables.items() if name in STAGING_TABLES}
    marts = {name: df for name, df in tables.items() if name in MART_TABLES}
    return load_all(staging, marts, root, run_id, rejected, pieces)


def run(sources: Mapping[str, DataFrame], root: str, run_id: str, as_of: str | dt.date, order: ArrivalOrder,
        lo: float = K.AMOUNT_MIN, hi: float = K.AMOUNT_MAX,
        tiebreak: Sequence[str] | None = None) -> tuple[bool, DataFrame | None]:
    """Transform, keep the rejects for audit, load staging tables, aggregates and marts, register the views:
    (success, journal rows).  The marts need all four sources.  What the run wrote in between is deleted, each part when
    nothing reads it any more.

    With all four, the cleaning and the models both read every source, so each is written first and computed once.
    The cleaned tables are written where they are to stay, and the loads at the end make them current.
    """
    spark = next(iter(sources.values())).sparkSession
    pieces: dict[str, Piece] = {}

    def write(df: DataFrame, name: str) -> DataFrame:
        if table_of(name) is None:
            return materialise(df, name)
        pieces[name] = write_piece(df, root, table_of(name))
        return spark.read.schema(df.schema).parquet(pieces[name].location)

    try:
        with scratch(spark):
            outside, whole = contextvars.copy_context(), set(sources) >= set(STAGING_TABLES)
            with scratch(spark):  # holds the sources, which go as soon as what is made of them is written
                if whole:
                    sources = {name: materialise(df, f"source-{name}") for name, df in sources.items()}
                tables = outside.run(transform, sources, as_of, order, lo, hi, write)
                rejected = {}
                if "transactions_rejetees" in tables:
                    write_rejects(tables["transactions_rejetees"], f"{root}/rejets", as_of)
                    rejected["transactions"] = tables["transactions_rejetees"].count()
                if whole:
                    made = outside.run(models, sources, as_of, lo, hi, tiebreak)
                    tables |= {name: df for name, df in made.items() if name in MART_TABLES}
            result = load(tables, root, run_id, rejected, pieces)
    finally:  # pieces that no load has made current: those of a run that failed, and empty ones
        drop_pieces(spark, root, {table_of(name): piece.location for name, piece in pieces.items()})
    if "ca_mensuel" in tables:
        register_views(spark, read_table(spark, root, "marts.ca_mensuel"))
    return result


def run_increment(source: DataFrame, root: str, name: str, keys: Sequence[str], updated: str = "date_maj",
                  run_id: str = "") -> DataFrame:
    """Extract what a source changed since its last mark, merge it into its staging table, store the new mark.

    Returns the journal row of the merge.  The mark is stored last: a run that fails before is repeated whole.
    """
    spark = source.sparkSession
    marks = read_table(spark, root, "staging.marques")
    if marks is None:
        mark_type = source.schema[updated].dataType.simpleString()
        marks = spark.createDataFrame([], f"table_cible string, derniere_extraction {mark_type}")
    delta = materialise(incremental_extract(source, marks, name, updated), "delta")
    loaded = load_table(delta, root, f"staging.{name}", UPSERT, keys, [updated], run_id)
    load_table(next_mark(delta, name, updated), root, "staging.marques", UPSERT, ["table_cible"],
               ["derniere_extraction"], run_id, buckets=1)
    return loaded


def models(sources: Mapping[str, DataFrame], as_of: str | dt.date, lo: float = K.AMOUNT_MIN,
           hi: float = K.AMOUNT_MAX, tiebreak: Sequence[str] | None = None,
           write: Callable[[DataFrame, str], DataFrame] = materialise,
           columns: Mapping[str, Collection[str]] | None = None) -> dict[str, DataFrame]:
    """The staging tables and the three marts.  The staged tables are written once for the marts (by ``write``, as in
    ``transform``): the fact because all three read it, the dimensions so that Spark knows their size when it joins them.

    A caller who reads some ``columns`` only names them by table: the fact and the clients are then staged in those and
    what the marts read, and the marts leave out what the others alone need.
    """
    wanted = columns or {}
    ties = {"tiebreak": tiebreak} if tiebreak else {}
    clients = stg_clients(sources["clients"])
    if "stg_clients" in wanted and "mart_clients" in wanted:
        read = {*CLIENT_COLUMNS, *wanted["stg_clients"], *wanted["mart_clients"]}
        clients = clients.select(*[c for c in clients.columns if c in read])
    clients = write(clients, "stg_clients")
    products = write(stg_products(sources["produits"]), "stg_produits")
    stores = write(stg_stores(sources["magasins"], as_of), "stg_magasins")
    tx = stg_transactions(sources["transactions"], lo, hi, **ties)
    if "stg_transactions" in wanted:
        tx = tx.select(*dict.fromkeys([*FACT_COLUMNS, *wanted["stg_transactions"]]))
    tx = write(tx, "stg_transactions")
    return {
        "stg_clients": clients,
        "stg_transactions": tx,
        "stg_produits": products,
        "stg_magasins": stores,
        "mart_ventes": sales_mart(tx, clients, products, stores, wanted.get("mart_ventes")),
        "mart_clients": client_mart(clients, tx, as_of, written=True, columns=wanted.get("mart_clients")),
        "mart_produits": product_mart(products, tx, written=True, columns=wanted.get("mart_produits")),
    }


def quality(sources: Mapping[str, DataFrame], run_date: str | dt.date, written: bool = False) -> DataFrame:
    """The daily quality report: all checks in one table.

    The fact is read once: the columns that are checked are written, and all checks read those.  ``written`` says that the
    sources are written tables, which the checks read as they lie.
    """
    tx = sources["transactions"].select("transaction_id", "date_transaction", "montant_total_xaf", "client_id",
                                        "produit_id", "magasin_id")
    if not written:
        tx = materialise(tx, "quality")
    dimensions = {"client_id": sources["clients"], "produit_id": sources["produits"],
                  "magasin_id": sources["magasins"]}
    return quality_summary(completeness_check(sources["clients"]), duplicate_check(tx), amount_anomalies(tx),
                           referential_check(tx, dimensions), daily_volume_check(tx, run_date))


def register_views(spark: SparkSession, monthly: DataFrame) -> None:
    """The two reporting views over the monthly revenue table."""
    executive_dashboard(monthly).createOrReplaceTempView("v_tableau_bord_executif")
    month_over_month(monthly).createOrReplaceTempView("v_evolution_ca")
