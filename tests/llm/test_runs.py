"""Periodic runs: the levels of catchers against the plain definition, and the functions on tables."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from etalage.llm import word_runs


def texts(rng):
    """Noise, repeated passages and periodic stretches over few words."""
    out = []
    while rng.random() < 0.85 and len(out) < 400:
        kind = rng.random()
        if kind < 0.4:
            out += [rng.randint(0, rng.choice([1, 2, 50])) for _ in range(rng.randint(0, 30))]
        elif kind < 0.8:
            unit = [rng.randint(0, 3) for _ in range(rng.randint(1, rng.choice([3, 12, 40])))]
            out += (unit * 7)[:rng.randint(1, 6 * len(unit))]
        elif out:
            a = rng.randrange(len(out))
            out += out[a:a + rng.randint(1, 60)]
    return out


@pytest.mark.parametrize("min_length, exponent", [(24, 3), (1, 3), (24, 2), (2, 2), (5, 2), (40, 4)])
def test_runs_of_many_texts(min_length, exponent):
    rng = random.Random(min_length * 10 + exponent)
    for _ in range(60):
        own = [texts(rng) for _ in range(rng.randint(0, 6))]
        got = word_runs.Runs([np.array(t, np.int64) for t in own], min_length, exponent).of_texts()
        assert got == [brute.word_runs(t, min_length, exponent) for t in own]


def test_levels_cover_every_period_once():
    for min_length, exponent in [(24, 3), (24, 2), (1, 2), (100, 5)]:
        seen = [(q, s) for s, a, b in word_runs._levels(2000, min_length, exponent) for q in range(a, b + 1)]
        assert [q for q, _ in seen] == list(range(1, 2000 // exponent + 1))
        assert all(2 * s - 1 <= word_runs.stretch(q, min_length, exponent) < 4 * s - 1 for q, s in seen)


def test_equal_hashes_do_not_make_runs(monkeypatch):
    """Blocks that only look equal: every run is compared word by word."""
    monkeypatch.setattr(word_runs, "_mixed", lambda x: x & np.uint64(0))
    rng = random.Random(5)
    for _ in range(20):
        own = texts(rng)
        assert word_runs.Runs([np.array(own, np.int64)], 24, 3).of_texts() == [brute.word_runs(own)]


def test_texts_pass_together_or_alone(spark, documents):
    frame = spark.createDataFrame(documents, "doc_id long, text string").coalesce(1)
    together = frame.select("doc_id", word_runs.runs(F.col("text"), 4, 2)["runs"].alias("r"))
    alone = spark.createDataFrame([r for r in documents[:40]], "doc_id long, text string").repartition(20)
    want = {(r["doc_id"], str(r["r"])) for r in together.collect()}
    assert {(r["doc_id"], str(r["r"])) for r in alone.select("doc_id", word_runs.runs(F.col("text"), 4, 2)["runs"].alias("r")).collect()} <= want


def test_collapse(docs):
    rows = [(1, None), (2, ""), (3, " a  b "), (4, "x " * 30), (5, "u " + "a b c " * 12 + " v\nw"), (5, "x " * 30)]
    out = word_runs.collapse_runs(docs(rows))
    assert out.columns == docs(rows).columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, None), (2, ""), (3, " a  b "), (4, "x"), (5, "u a b c v w"), (5, "x")], key=str)
    assert out.where("drop <> 'x'").count() == 0


def test_least_exponent():
    with pytest.raises(ValueError):
        word_runs.Runs([], 1, 1)
