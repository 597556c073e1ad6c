"""Stages load what they have written as it lies."""

import os

from etalage.plans import stages
from etalage.sinks import warehouse as W
from etalage.storage import materialise
from test_written_once import ORDER, sources  # noqa: F401 (a fixture)


def test_stages_load_their_tables_as_they_lie(spark, sources, folder, monkeypatch):
    run = stages.StagedRun(spark, folder, "nuit", "2024-06-01", ORDER, 1, 100_000)
    written, plain = [], stages.daily.quality
    monkeypatch.setattr(stages.daily, "materialise", lambda df, tag: written.append(tag) or materialise(df, tag))
    monkeypatch.setattr(stages.daily, "quality", lambda *a, **k: plain(*a, **k))
    run.run(sources)
    assert "quality" not in written
    files = {}
    for stage, names in ((stages.TRANSFORM, ["transactions", "clients", "ca_mensuel"]), (stages.MODELS, ["mart_ventes"])):
        for name in names:
            files[name] = run.tables(stage)[name].inputFiles()
            assert W.read_table(spark, folder, W.table_of(name)).inputFiles() == files[name]
    assert run.summary().where("nom_table = 'transactions'").count() == 3  # extracted, transformed and loaded
    # a stage that is done again changes nothing before it is loaded; what is done once more goes
    for _ in range(2):
        run.start(stages.TRANSFORM)
        assert W.read_table(spark, folder, "staging.transactions").inputFiles() == files["transactions"]
        assert len(os.listdir(f"{folder}/staging/transactions")) == 2
    run.start(stages.LOAD)
    again = run.tables(stages.TRANSFORM)["transactions"]
    assert W.read_table(spark, folder, "staging.transactions").inputFiles() == again.inputFiles() != files["transactions"]
    assert again.count() == 30
