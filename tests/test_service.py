"""Service levels: runs, success over the last days, availability."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from etalage import contracts as K
from etalage.sinks import service
from etalage.sinks.warehouse import DONE, FAILED

JOURNAL = ("table_cible string, nb_lignes_inserees long, nb_lignes_rejetees long, statut string, debut_chargement timestamp_ntz, "
           "fin_chargement timestamp_ntz, pipeline_run_id string")


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def journal(spark):
    def make(*loads):
        return spark.createDataFrame([(t, n, 1, s, a and at(a), b and at(b), run) for run, t, s, a, b, n in loads], JOURNAL)
    return make


def by_run(df):
    return {r["pipeline_run_id"]: r for r in df.collect()}


def test_a_table_that_was_loaded_again_is_no_failure(journal):
    found = by_run(service.pipeline_runs(journal(
        ("a", "t", FAILED, "2024-05-06 02:00:00", "2024-05-06 02:10:00", 0),
        ("a", "t", DONE, "2024-05-06 02:20:00", "2024-05-06 02:30:00.5", 7),
        ("b", "t", DONE, "2024-05-06 02:00:00", "2024-05-06 02:10:00", 7),
        ("b", "u", FAILED, "2024-05-06 02:10:00", "2024-05-06 02:10:00", 0),
        ("c", "t", DONE, "2024-05-06 02:00:00", "2024-05-06 02:10:00", 7),
        ("c", "t", FAILED, "2024-05-06 02:00:00", "2024-05-06 02:10:00", 0))))
    assert (found["a"]["statut"], found["a"]["nb_echecs"], found["a"]["nb_chargements"], found["a"]["nb_tables"]) == (DONE, 1, 2, 1)
    assert (found["a"]["duree_secondes"], found["a"]["nb_lignes_inserees"], found["a"]["nb_lignes_rejetees"]) == (1800, 7, 2)
    assert found["a"]["statut_service"] == K.STATUS_OK
    assert found["b"]["statut"] == found["c"]["statut"] == FAILED
    assert found["b"]["a_l_heure"] and found["b"]["statut_service"] == K.STATUS_ALERT


def test_times_are_kept_to(journal):
    found = by_run(service.pipeline_runs(journal(
        ("late", "t", DONE, "2024-05-06 05:00:00", "2024-05-06 06:00:00", 1),
        ("in time", "t", DONE, "2024-05-06 05:00:00", "2024-05-06 05:59:59.999999", 1),
        ("long", "t", DONE, "2024-05-06 02:00:00", "2024-05-06 04:00:00", 1),
        ("evening", "t", DONE, "2024-05-06 23:30:00", "2024-05-07 00:10:00", 1),
        ("timeless", "t", DONE, None, None, 1),
        ("", "t", FAILED, "2024-05-06 02:00:00", "2024-05-06 04:00:00", 1),
        (None, "t", FAILED, "2024-05-06 02:00:00", "2024-05-06 04:00:00", 1))))
    kept = {run: (r["a_l_heure"], r["dans_le_delai"], r["statut_service"]) for run, r in found.items()}
    assert kept == {"late": (False, True, "ALERTE"), "in time": (True, True, "OK"), "long": (True, False, "ALERTE"),
                    "evening": (False, True, "ALERTE"), "timeless": (False, False, "ALERTE")}
    assert found["timeless"]["jour"] is None and found["timeless"]["duree_secondes"] is None


def test_times_have_no_zone(spark, journal):
    """The night on which clocks go forward is as long as any other."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        run, = service.pipeline_runs(journal(("a", "t", DONE, "2024-03-31 01:30:00", "2024-03-31 03:29:59", 1))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (run["duree_secondes"], run["dans_le_delai"], run["jour"]) == (7199, True, dt.date(2024, 3, 31))


def test_rates_and_availability_against_plain_ones(spark):
    rng = random.Random(7)
    runs = [(dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(150)), rng.choice([DONE] * 9 + [FAILED])) for _ in range(200)]
    df = spark.createDataFrame([*runs, (None, FAILED)], "jour date, statut string")

    def percent(part, whole):
        return round(100.0 * part / whole, 2)

    found = {r["jour"]: r for r in service.success_rate(df, 30, 90.0).collect()}
    assert set(found) == {d for d, _ in runs}
    for day, r in found.items():
        recent = [s for d, s in runs if day - dt.timedelta(29) <= d <= day]
        good = recent.count(DONE)
        assert (r["nb_executions_fenetre"], r["nb_succes_fenetre"]) == (len(recent), good)
        assert r["taux_succes_pct"] == pytest.approx(percent(good, len(recent)), abs=0.011)
        assert r["statut_service"] == ("OK" if good * 10 > len(recent) * 9 else "ALERTE")

    days = [min(d for d, _ in runs) + dt.timedelta(i) for i in range((max(d for d, _ in runs) - min(d for d, _ in runs)).days + 1)]
    served = {d for d, s in runs if s == DONE}
    for r in service.availability(df, 75.0).collect():
        working = [d for d in days if d.weekday() < 5 and d.strftime("%Y-%m") == r["mois_annee"]]
        good = sum(d in served for d in working)
        assert (r["nb_jours_ouvres"], r["nb_jours_servis"]) == (len(working), good)
        assert r["statut_service"] == ("OK" if good * 4 >= len(working) * 3 else "ALERTE")


def test_rate_on_the_limit(spark):
    """The success rate must be above its limit, availability may be on it."""
    day = dt.date(2024, 5, 6)  # a Monday
    runs = spark.createDataFrame([(day, DONE)] * 49 + [(day, FAILED)], "jour date, statut string")
    assert service.success_rate(runs).first()["statut_service"] == "ALERTE"
    assert service.success_rate(runs, minimum=97.9).first()["statut_service"] == "OK"
    assert service.availability(runs, minimum=100.0).first()["statut_service"] == "OK"


def test_no_runs(journal):
    runs = service.pipeline_runs(journal().where(F.lit(False)))
    assert runs.isEmpty() and service.success_rate(runs).isEmpty() and service.availability(runs).isEmpty()
