"""Declared column tests and table constraints, run as counting jobs.

Spark does not enforce keys or checks, so they are verified: one aggregate per table for all row-wise
tests, one grouped aggregate per unique key, one anti join per relationship.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from etalage import contracts as K
from etalage.operators.rows import broken_references, union_aligned


@dataclass(frozen=True)
class ColumnTest:
    """``kind``: not_null, unique, accepted_values, relationships or positive."""

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    to: str | None = None
    key: tuple[str, ...] = field(default=())

    @property
    def label(self) -> str:
        return "+".join(self.key) if self.key else self.column


def _not_null(table: str, *columns: str) -> list[ColumnTest]:
    return [ColumnTest(table, c, "not_null") for c in columns]


def _unique(table: str, *columns: str) -> ColumnTest:
    return ColumnTest(table, columns[0], "unique", key=columns if len(columns) > 1 else ())


def _accepted(table: str, column: str, *values: str) -> ColumnTest:
    return ColumnTest(table, column, "accepted_values", values)


# The declared tests of the staging views and the marts.
MODEL_TESTS = [
    *_not_null("stg_clients", "client_id", "nom", "email", "ville", "categorie_client"),
    _unique("stg_clients", "client_id"),
    _accepted("stg_clients", "ville", "Brazzaville", "Pointe-Noire", "Dolisie", "Ouesso", "Nkayi", "Impfondo"),
    _accepted("stg_clients", "categorie_client", "Standard", "Premium", "VIP"),
    _accepted("stg_clients", "sexe", "M", "F", "Inconnu"),
    *_not_null("stg_transactions", "transaction_id", "client_id", "montant_total_xaf", "mode_paiement"),
    _unique("stg_transactions", "transaction_id"),
    ColumnTest("stg_transactions", "client_id", "relationships", to="stg_clients"),
    _accepted("stg_transactions", "statut_transaction", "Validé", "En attente", "Remboursé"),
    _accepted("stg_transactions", "mode_paiement", "Espèces", "Mobile Money", "Carte bancaire", "Virement"),
    *_not_null("stg_produits", "produit_id", "categorie", "prix_unitaire_xaf"),
    _unique("stg_produits", "produit_id"),
    *_not_null("stg_magasins", "magasin_id", "ville"),
    _unique("stg_magasins", "magasin_id"),
    _accepted("stg_magasins", "statut", "Actif"),
    *_not_null("mart_ventes", "mois_annee", "magasin_id", "ca_total_xaf", "nb_transactions"),
    *_not_null("mart_clients", "client_id", "ca_total_xaf", "segment_rfm"),
    _unique("mart_clients", "client_id"),
    _accepted("mart_clients", "segment_rfm", "Champions", "Clients fidèles", "Clients à risque",
              "Clients inactifs", "Clients en développement", "Jamais acheté"),
    *_not_null("mart_produits", "produit_id", "ca_total_xaf"),
    _unique("mart_produits", "produit_id"),
    _accepted("mart_produits", "categorie_performance", "Top 10 CA", "Produit clé", "Produit standard",
              "Aucune vente"),
]

# The constraints of the warehouse tables.
TABLE_CONSTRAINTS = [
    *_not_null("transactions", "transaction_id", "date_transaction", "quantite", "prix_unitaire_xaf",
               "montant_total_xaf"),
    ColumnTest("transactions", "quantite", "positive"),
    ColumnTest("transactions", "montant_total_xaf", "positive"),
    _unique("transactions", "transaction_id"),
    *_not_null("clients", "client_id", "nom"),
    _unique("clients", "client_id"),
    *_not_null("produits", "produit_id", "nom_produit"),
    _unique("produits", "produit_id"),
    *_not_null("magasins", "magasin_id"),
    _unique("magasins", "magasin_id"),
    *_not_null("ca_mensuel", "mois_annee", "annee", "mois"),
    _unique("ca_mensuel", "mois_annee", "magasin_id"),
    _unique("top_produits", "produit_id"),
    _unique("performance_magasins", "magasin_id"),
    _unique("segmentation_rfm", "client_id"),
]


def _row_failure(test: ColumnTest) -> Column:
    value = F.col(test.column)
    if test.kind == "not_null":
        return value.isNull()
    if test.kind == "accepted_values":
        return ~value.isin(*test.values)
    return ~(value > 0)


def _result(one_row: DataFrame, test: ColumnTest, failures: Column) -> DataFrame:
    return one_row.select(F.lit(test.table).alias("table"), F.lit(test.label).alias("column"),
                          F.lit(test.kind).alias("test"), failures.alias("failures"))


def _row_tests(df: DataFrame, tests: Sequence[ColumnTest]) -> DataFrame:
    counted = df.agg(*[F.count_if(_row_failure(t)).alias(f"t{i}") for i, t in enumerate(tests)])
    rows = [F.struct(F.lit(t.table).alias("table"), F.lit(t.label).alias("column"), F.lit(t.kind).alias("test"),
                     F.col(f"t{i}").alias("failures")) for i, t in enumerate(tests)]
    return counted.select(F.inline(F.array(*rows)))


def _unique_test(df: DataFrame, test: ColumnTest) -> DataFrame:
    keys = list(test.key) or [test.column]
    repeated = df.na.drop(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return _result(repeated.agg(F.count(F.lit(1)).alias("n")), test, F.col("n"))


def _relationship_test(df: DataFrame, parent: DataFrame, test: ColumnTest) -> DataFrame:
    broken = broken_references(df, parent, test.column)
    return _result(broken.agg(F.count(F.lit(1)).alias("n")), test, F.col("n"))


def tested_columns(table: str, tests: Sequence[ColumnTest]) -> list[str]:
    """The columns of a table that tests read, those that others refer to among them."""
    own = [c for t in tests if t.table == table for c in (t.column, *t.key)]
    return list(dict.fromkeys(own + [t.column for t in tests if t.to == table]))


def run_column_tests(tables: Mapping[str, DataFrame], tests: Sequence[ColumnTest] = tuple(MODEL_TESTS)) -> DataFrame:
    """One row per test: table, column, test, failures, status.  Tests of absent tables are listed as not run.

    Pass written tables: each of them is read a few times.
    """
    parts = []
    for table, df in tables.items():
        own = [t for t in tests if t.table == table]
        row_wise = [t for t in own if t.kind in ("not_null", "accepted_values", "positive")]
        if row_wise:
            parts.append(_row_tests(df, row_wise))
        parts += [_unique_test(df, t) for t in own if t.kind == "unique"]
        parts += [_relationship_test(df, tables[t.to], t) for t in own if t.kind == "relationships" and t.to in tables]
    if not parts:
        raise ValueError("none of the tests' tables is given")
    absent = [t for t in tests if t.table not in tables or (t.kind == "relationships" and t.to not in tables)]
    if absent:
        schema = "table string, column string, test string, failures bigint"
        parts.append(parts[0].sparkSession.createDataFrame([(t.table, t.label, t.kind, None) for t in absent], schema))
    results = union_aligned(*parts)
    return results.withColumn("status", F.when(F.col("failures").isNull(), K.STATUS_NOT_RUN)
                              .when(F.col("failures") == 0, K.STATUS_OK).otherwise(K.STATUS_ALERT))
