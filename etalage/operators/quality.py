"""Data-quality checks.  Each check is a table of (check, metric, value, threshold, status) rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from etalage import contracts as K
from etalage.functions import dates
from etalage.functions.numbers import ratio, round_half_even, safe_rate
from etalage.functions.rules import Rule, any_broken, validate_rows
from etalage.operators.quantiles import quantiles
from etalage.operators.rows import duplicate_count, duplicate_rows, key_set_difference, row_hash, union_aligned
from etalage.storage import materialise


def _long(one_row: DataFrame, check: str, metrics: Sequence[tuple[str, Column, float | None, Column]]) -> DataFrame:
    """Turn a one-row table into metric rows: (name, value, threshold, within bounds)."""
    rows = [F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"),
                     F.lit(threshold).cast("double").alias("threshold"),
                     F.when(F.coalesce(good, F.lit(False)), K.STATUS_OK).otherwise(K.STATUS_ALERT).alias("status"))
            for name, value, threshold, good in metrics]
    return one_row.select(F.inline(F.array(*rows))).select(F.lit(check).alias("check"), "*")


def _profile_counts(df: DataFrame, rules: Sequence[Rule] = ()) -> DataFrame:
    """One row from one pass: rows, filled values per column and invalid rows."""
    invalid = F.count_if(any_broken(rules)) if rules else F.lit(0).cast("long")
    return df.agg(F.count(F.lit(1)).alias("total"), invalid.alias("invalid"),
                  *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])


def _marked_counts(marks: DataFrame) -> DataFrame:
    """The same from a mark per filled value and broken row."""
    return marks.agg(F.count(F.lit(1)).alias("total"), F.count_if("__broken").alias("invalid"),
                     *[F.count(c).alias(f"n{c[1:]}") for c in marks.columns if c not in ("__h", "__broken")])


def _completeness(i: int) -> Column:
    filled = round_half_even(ratio(F.col(f"n{i}"), F.col("total")) * F.lit(100.0), 2)
    return F.coalesce(filled, F.lit(0.0))


def column_profile(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Rows, nulls and completeness per column."""
    rows = F.array(*[F.struct(F.lit(c).alias("colonne"),
                              (F.col("total") - F.col(f"n{i}")).alias("valeurs_nulles"),
                              _completeness(i).alias("taux_completude")) for i, c in enumerate(df.columns)])
    return (_profile_counts(df) if counts is None else counts).select(F.col("total").alias("nb_lignes_total"), F.inline(rows))


def quality_report(df: DataFrame, name: str, rules: Sequence[Rule] = (), written: bool = True) -> tuple[DataFrame, DataFrame]:
    """(summary, per column): size, completeness, identical rows, invalid rows and an overall score.

    Pass a written table, or say that it is not ``written``, as one that is parsed from text: then one pass over it writes
    a hash per row and which values are there, and it is read again only if hashes repeat.
    """
    hashes = None if written else materialise(
        df.select(*[F.when(F.col(f"`{c}`").isNotNull(), F.lit(True)).alias(f"c{i}") for i, c in enumerate(df.columns)],
                  row_hash(df).alias("__h"), any_broken(rules).alias("__broken")), name)
    width, counts = len(df.columns), materialise(_profile_counts(df, rules) if written else _marked_counts(hashes), "profile")
    rates = F.array(*[_completeness(i) for i in range(width)])
    nulls = F.array(*[F.col("total") - F.col(f"n{i}") for i in range(width)])
    unique_pct = (F.lit(1.0) - ratio(F.col("doublons"), F.greatest("total", F.lit(1)))) * F.lit(100.0)
    mean_rate = F.aggregate(rates, F.lit(0.0), lambda acc, x: acc + x) / F.lit(float(width))
    summary = counts.withColumn("doublons", duplicate_rows(df, hashes).scalar()).select(
        F.lit(name).alias("dataset"),
        F.col("total").alias("nb_lignes_total"),
        F.lit(width).alias("nb_colonnes"),
        F.aggregate(nulls, F.lit(0).cast("long"), lambda acc, x: acc + x).alias("valeurs_nulles"),
        "doublons",
        F.col("invalid").alias("lignes_invalides"),
        round_half_even((mean_rate + unique_pct) / F.lit(2.0), 2).alias("score_qualite"),
    )
    return summary, column_profile(df, counts)


def error_details(df: DataFrame, rules: Sequence[Rule], per_row: int | None = None) -> DataFrame:
    """The messages of every invalid row, one row each, or the first ``per_row`` of each; the table stays distributed."""
    messages = F.col("erreurs") if per_row is None else F.slice("erreurs", 1, per_row)
    return validate_rows(df, rules).select(F.explode(messages).alias("erreur"))


def completeness_check(df: DataFrame, columns: Sequence[str] = tuple(K.CRITICAL_CLIENT_COLUMNS),
                       minimum: float = K.COMPLETENESS_MIN_PCT) -> DataFrame:
    """Share of filled values per critical column; 0 for a column the table lacks."""
    counted = df.agg(F.count(F.lit(1)).alias("__total"),
                     *[F.count(c).alias(c) for c in columns if c in df.columns])
    metrics = []
    for c in columns:
        rate = safe_rate(F.col(c), F.col("__total")) if c in df.columns else F.lit(0.0)
        metrics.append((c, rate, minimum, rate >= minimum))
    return _long(counted, "completude", metrics)


def duplicate_check(df: DataFrame, key: str = "transaction_id", maximum: float = K.DUPLICATES_MAX_PCT) -> DataFrame:
    counts = duplicate_count(df, [key])
    rate = safe_rate(F.col("nb_doublons"), F.col("nb_total"))
    return _long(counts, "doublons", [
        ("nb_doublons", F.col("nb_doublons"), None, rate <= maximum),
        ("taux_doublons", rate, maximum, rate <= maximum),
    ])


def amount_anomalies(df: DataFrame, col: str = "montant_total_xaf", k: float = K.IQR_FACTOR,
                     zmax: float = K.ZSCORE_MAX, exact: bool = True) -> DataFrame:
    """Outliers by quartiles and by z-score, amounts at or below zero, median."""
    value = F.col(col).cast("double")
    q = quantiles(df, col, [0.25, 0.5, 0.75], exact).scalar()
    moments = df.agg(F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")).alias("m")).scalar()
    bounded = df.select(value.alias("v"), q.alias("q"), moments.alias("m"))
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(2))
    spread = q3 - q1
    z = F.abs(F.try_divide(F.col("v") - F.col("m.mean"), F.col("m.std")))
    counts = bounded.agg(
        F.count_if((F.col("v") < q1 - F.lit(k) * spread) | (F.col("v") > q3 + F.lit(k) * spread)).alias("iqr"),
        F.count_if(z > zmax).alias("z"),
        F.count_if(F.col("v") <= 0).alias("nonpos"),
        F.first(F.get("q", F.lit(1))).alias("median"),
    )
    any_ok = F.lit(True)
    return _long(counts, "anomalies_montants", [
        ("montant_median", F.col("median"), None, any_ok),
        ("outliers_iqr", F.col("iqr"), None, any_ok),
        ("outliers_zscore", F.col("z"), zmax, any_ok),
        ("montants_invalides", F.col("nonpos"), 0, F.col("nonpos") == 0),
    ])


def referential_check(tx: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct keys of the fact that each dimension lacks; ``dimensions`` maps key to table."""
    named = F.array(*[F.struct(F.lit(key).alias("key"), F.col(key).cast("string").alias("k")) for key in dimensions])
    used = tx.select(F.inline(named)).distinct()  # all keys in one pass over the fact
    known = union_aligned(*[dimension.select(F.lit(key).alias("key"), F.col(key).cast("string").alias("k"))
                            for key, dimension in dimensions.items()]).distinct().withColumn("known", F.lit(True))
    counts = used.join(known, ["key", "k"], "left").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("known").isNull()).alias("orphans"))
    one_row = counts.agg(F.sum("orphans").alias("orphans"),
                         *[F.max(F.when(F.col("key") == key, F.col(c))).alias(f"{key}_{c}")
                           for key in dimensions for c in ("n", "orphans")])
    metrics = []
    for key in dimensions:
        n, orphans = F.col(f"{key}_n"), F.col(f"{key}_orphans")
        share = round_half_even(ratio(orphans, F.greatest(n, F.lit(1))) * F.lit(100.0), 1)
        metrics += [(f"{key}_distincts", n, None, F.lit(True)),
                    (f"{key}_orphelins", orphans, 0, orphans == 0),
                    (f"{key}_orphelins_pct", share, 0, orphans == 0)]
    ok = F.col("orphans") == 0
    return _long(one_row, "coherence_referentielle", [*metrics, ("coherence_ok", ok.cast("int"), 1, ok)])


def orphan_keys(tx: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """The orphan keys themselves: (colonne, valeur)."""
    parts = [key_set_difference(tx, dimension, key)
             .select(F.lit(key).alias("colonne"), F.col(key).cast("string").alias("valeur"))
             for key, dimension in dimensions.items()]
    return union_aligned(*parts)


def daily_volume_check(df: DataFrame, run_date: str | dt.date, date: str = "date_transaction",
                       minimum: int = K.DAILY_ROWS_MIN) -> DataFrame:
    """Rows dated the day before the run."""
    eve = F.date_sub(dates.day(run_date), 1)
    counts = df.where(F.col(date).cast("date") == eve).agg(F.count(F.lit(1)).alias("n"))
    return _long(counts, "volume", [("nb_transactions_du_jour", F.col("n"), minimum, F.col("n") >= minimum)])


def daily_volume(df: DataFrame, date: str = "date_transaction", minimum: int = K.DAILY_ROWS_MIN) -> DataFrame:
    """Rows per day with the status of each day."""
    per_day = df.groupBy(F.col(date).cast("date").alias("jour")).agg(F.count(F.lit(1)).alias("nb_lignes"))
    return per_day.withColumn("statut", F.when(F.col("nb_lignes") >= minimum, K.STATUS_OK)
                                         .otherwise(K.STATUS_ALERT))


def null_rate_alert(df: DataFrame, maximum: float = K.NULL_RATE_MAX_PCT, amounts: Sequence[str] = (),
                    date_bounds: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Null rate per column, amounts that are not positive, dates outside their bounds: one pass."""
    total = F.count(F.lit(1))
    counted = [total.alias("__total"), *[F.count(F.col(c)).alias(f"n_{c}") for c in df.columns]]
    counted += [F.count_if(F.col(c) <= 0).alias(f"p_{c}") for c in amounts]
    bounds = dict(date_bounds or {})
    counted += [F.count_if(~F.col(c).cast("date").between(dates.day(lo), dates.day(hi))).alias(f"d_{c}")
                for c, (lo, hi) in bounds.items()]
    metrics = []
    for c in df.columns:
        rate = safe_rate(F.col("__total") - F.col(f"n_{c}"), F.col("__total"))
        metrics.append((f"nullite_{c}", rate, maximum, rate <= maximum))
    metrics += [(f"non_positifs_{c}", F.col(f"p_{c}"), 0, F.col(f"p_{c}") == 0) for c in amounts]
    metrics += [(f"hors_periode_{c}", F.col(f"d_{c}"), 0, F.col(f"d_{c}") == 0) for c in bounds]
    return _long(df.agg(*counted), "nullite", metrics)


def stockout_rate(stock: DataFrame, maximum: float = K.STOCKOUT_MAX_PCT) -> DataFrame:
    """Share of stock lines in alert."""
    counts = stock.agg(F.count(F.lit(1)).alias("n"), F.count_if("alerte_rupture").alias("low"))
    rate = safe_rate(F.col("low"), F.col("n"))
    return _long(counts, "rupture_stock", [("taux_rupture", rate, maximum, rate <= maximum)])


def quality_summary(*checks: DataFrame) -> DataFrame:
    """All metric rows in one table."""
    return union_aligned(*checks)
