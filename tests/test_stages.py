"""Staged runs: order, resumption after a failure, and the command line."""

import pytest
from pyspark.sql import functions as F

from etalage import __main__ as command
from etalage.plans import daily, stages
from etalage.plans.star import AMOUNT_MAX, AMOUNT_MIN, AS_OF, TX_ORDER, Star
from etalage.sinks.warehouse import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Some of the sources as CSV files."""
    folder, star = str(tmp_path_factory.mktemp("raw")), Star(spark, SF)
    sources = star.sources() | {"transactions": star.faulty_transactions().where(F.substring("client_id", 2, 9).cast("int") <= 20)}
    for name, df in sources.items():
        df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")
    return folder


def arguments(raw, root, *more):
    return ["--raw", raw, "--root", root, "--run-id", "nuit", "--as-of", AS_OF, "--min", str(AMOUNT_MIN), "--max", str(AMOUNT_MAX), *more]


def test_a_run_goes_on_where_it_failed(spark, raw, tmp_path, monkeypatch, capsys):
    root = str(tmp_path)
    run = stages.StagedRun(spark, root, "nuit", AS_OF, daily.ArrivalOrder(["date_inscription"], TX_ORDER), AMOUNT_MIN, AMOUNT_MAX)
    with pytest.raises(stages.MissingStage):
        run.start(stages.TRANSFORM)
    assert command.main(arguments(raw, root, "--stage", "load"), spark) == 1
    with pytest.raises(ValueError):
        run.run({}, ["tout"])

    plain = daily.models
    monkeypatch.setattr(daily, "models", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        command.main(arguments(raw, root), spark)
    assert [run.complete(s) for s in stages.STAGES] == [True, True, False, False, False]
    before = run.tables(stages.EXTRACT)["transactions"].inputFiles()

    monkeypatch.setattr(daily, "models", plain)
    assert command.main(arguments(raw, root), spark) == 0
    assert all(run.complete(s) for s in stages.STAGES)
    assert run.tables(stages.EXTRACT)["transactions"].inputFiles() == before
    printed = capsys.readouterr().out
    assert "mart_ventes" in printed and "succès" in printed

    counts = {(r["etape"], r["nom_table"]): r["nb_lignes"] for r in run.summary().collect()}
    for name, df in run.tables(stages.TRANSFORM).items():
        assert counts["transform", name] == df.count()
    assert counts["staging", "transactions"] == counts["transform", "transactions"] == read_table(spark, root, "staging.transactions").count()
    assert counts["transform", "transactions_rejetees"] > 0
    assert spark.read.option("header", True).csv(f"{root}/rejets/date_rejet={AS_OF}").count() == counts["transform", "transactions_rejetees"]
    assert counts["extract", "transactions"] > counts["transform", "transactions"]
    assert counts["marts", "mart_clients"] == counts["models", "mart_clients"]
    assert spark.table("v_evolution_ca").count() == run.tables(stages.TRANSFORM)["ca_mensuel"].select("mois_annee").distinct().count()

    # A stage that is asked for by name is done again.
    assert command.main(arguments(raw, root, "--stage", "quality"), spark) == 0
    assert run.tables(stages.QUALITY)["controles"].count() == 21
