"""Service levels, read off the journal of loads: runs, their success over the last days, availability.

The journal has one row per load, so everything here is aggregated per run and then per day before any window; what
is left then is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from etalage import contracts as K
from etalage.functions import dates
from etalage.functions.numbers import ratio, round_half_even
from etalage.functions.text import is_blank
from etalage.sinks.warehouse import DONE, FAILED


def pipeline_runs(journal: DataFrame, due: int = K.RUN_DUE_SECONDS, longest: int = K.RUN_MAX_SECONDS) -> DataFrame:
    """One row per run: its day, times, loads and rows, and whether it kept to time.

    A run has failed if the last load of one of its tables did; a table that failed and was loaded afterwards is
    a failure among ``nb_echecs`` only.  Of loads that ended together a failed one counts as the last.  ``a_l_heure``
    says that it ended within ``due`` seconds after midnight of the day it began on, ``dans_le_delai`` that it took
    less than ``longest`` seconds; a run without times kept to neither.  Loads that name no run are left out.
    """
    named = journal.where(~is_blank(F.col("pipeline_run_id")))
    failed = F.col("statut") == FAILED
    # the last load is a failed one if no load ended after the last of those; plain columns, so that nothing is sorted
    lost = F.max("fin_chargement").eqNullSafe(F.max(F.when(failed, F.col("fin_chargement")))) & (F.count_if(failed) > 0)
    per_table = named.groupBy("pipeline_run_id", "table_cible").agg(
        F.min("debut_chargement").alias("debut"), F.max("fin_chargement").alias("fin"),
        F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("failures"), lost.alias("lost"),
        F.sum("nb_lignes_inserees").alias("inserted"), F.sum("nb_lignes_rejetees").alias("rejected"))
    runs = per_table.groupBy("pipeline_run_id").agg(
        F.min("debut").alias("debut"), F.max("fin").alias("fin"),
        F.count(F.lit(1)).alias("nb_tables"), F.sum("n").alias("nb_chargements"), F.sum("failures").alias("nb_echecs"),
        F.coalesce(F.sum("inserted"), F.lit(0)).alias("nb_lignes_inserees"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("nb_lignes_rejetees"),
        F.when(F.bool_or("lost"), FAILED).otherwise(DONE).alias("statut"))
    midnight, took = F.to_date("debut").cast("timestamp_ntz"), _seconds(F.col("debut"), F.col("fin"))
    in_time = F.coalesce(_seconds(midnight, F.col("fin")) < due, F.lit(False))
    short = F.coalesce(took < longest, F.lit(False))
    return runs.select(
        "pipeline_run_id", F.to_date("debut").alias("jour"), "debut", "fin",
        F.floor(took).cast("long").alias("duree_secondes"),
        "nb_tables", "nb_chargements", "nb_echecs", "nb_lignes_inserees", "nb_lignes_rejetees", "statut",
        in_time.alias("a_l_heure"), short.alias("dans_le_delai"),
        _status((F.col("statut") == DONE) & in_time & short).alias("statut_service"))


def success_rate(runs: DataFrame, days: int = K.SUCCESS_DAYS, minimum: float = K.SUCCESS_MIN_PCT) -> DataFrame:
    """Per day with runs: the share of runs that succeeded in the last ``days`` days, that day among them.

    The rate must be above ``minimum``.  Runs without a day are left out.
    """
    per_day = runs.where(F.col("jour").isNotNull()).groupBy("jour").agg(
        F.count(F.lit(1)).alias("nb_executions"), F.count_if(F.col("statut") == DONE).alias("nb_succes"))
    # one row per day: bounded by the calendar
    recent = Window.orderBy(F.datediff("jour", dates.day("1970-01-01"))).rangeBetween(1 - days, 0)
    out = per_day.withColumns({"nb_executions_fenetre": F.sum("nb_executions").over(recent),
                               "nb_succes_fenetre": F.sum("nb_succes").over(recent)})
    n, good = F.col("nb_executions_fenetre"), F.col("nb_succes_fenetre")
    return out.withColumns({"taux_succes_pct": _percent(good, n),
                            "statut_service": _status(good * 100.0 > n * float(minimum))})


def availability(runs: DataFrame, minimum: float = K.AVAILABILITY_MIN_PCT) -> DataFrame:
    """Per month: the share of working days, Monday to Friday, on which a run succeeded.

    The days go from the first run's to the last one's, so a day without any run counts as lost.
    """
    span = runs.agg(F.min("jour").alias("first"), F.max("jour").alias("last"))
    working = span.select(F.explode(F.sequence("first", "last")).alias("jour")).where(F.weekday("jour") < 5)
    served = runs.where(F.col("statut") == DONE).select("jour").distinct().withColumn("served", F.lit(True))
    months = working.join(served, "jour", "left").groupBy(dates.month_key(F.col("jour")).alias("mois_annee")).agg(
        F.count(F.lit(1)).alias("nb_jours_ouvres"), F.count("served").alias("nb_jours_servis"))
    n, good = F.col("nb_jours_ouvres"), F.col("nb_jours_servis")
    return months.withColumns({"disponibilite_pct": _percent(good, n),
                               "statut_service": _status(good * 100.0 >= n * float(minimum))})


def _seconds(start: Column, end: Column) -> Column:
    """Seconds with six digits between two times without a zone, whatever the session's zone."""
    took = end - start
    part = {unit: F.extract(F.lit(unit), took) for unit in ("DAY", "HOUR", "MINUTE", "SECOND")}
    return (part["DAY"].cast("long") * 24 + part["HOUR"]) * 3600 + part["MINUTE"] * 60 + part["SECOND"]


def _percent(part: Column, whole: Column) -> Column:
    return round_half_even(ratio(part, whole) * F.lit(100.0), 2)


def _status(good: Column) -> Column:
    return F.when(good, K.STATUS_OK).otherwise(K.STATUS_ALERT)
