"""Substring de-duplication by seed and extend, on short windows and hot groups."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from etalage.llm import substring_dedup as S


def corpus(rng, n=120):
    """Noise with passages that some, many or a third of all documents share, near copies and repeats in one document."""
    word = lambda: f"w{rng.randint(0, 400)}"
    passages = [[word() for _ in range(rng.choice([7, 9, 12, 30]))] for _ in range(12)]
    out = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += [word() for _ in range(rng.randint(0, 12))]
            text += passages[0] if rng.random() < 0.4 else rng.choice(passages)
        if rng.random() < 0.2 and out and out[-1][1]:
            text = out[-1][1].split()
            text[rng.randrange(len(text))] = "new"
        if rng.random() < 0.1:
            text = ["a"] * rng.randint(0, 40) + text + text
        out.append((rng.randint(0, 2 * n), "  ".join(text)))
    return out + [(None, out[0][1]), (None, None), (1, None), (2, ""), *out[:6]]


@pytest.mark.parametrize("length", [1, 2, 3, 8, 11])
def test_short_windows(spark, length):
    rows = corpus(random.Random(length))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out, spans = S.with_repeats(df, length=length)
    got = out.select("doc_id", S._digests(length)(F.col("text"), F.col(spans)).alias("d")).select("doc_id", "d.*")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = brute.earlier_windows(rows, length)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert any(r[2] for r in want)


def test_windows_are_covered_by_one_block_each():
    rng = random.Random(2)
    texts = [[f"w{rng.randint(0, 5)}".encode() for _ in range(rng.choice([0, 3, 8, 9, 200]))] for _ in range(30)]
    found = dict(S.blocks(texts, 8))
    for i, t in enumerate(texts):
        windows = [w for start, n, _, _ in found.get(i, []) for w in range(start, start + n)]
        assert windows == list(range(len(t) - 8 + 1))


def test_equal_windows_pick_equal_anchors():
    """Wherever a window stands, its block has the same anchor."""
    rng = random.Random(3)
    shared = [f"s{rng.randint(0, 99)}".encode() for _ in range(8)]
    keys = set()
    for _ in range(20):
        before, after = ([f"x{rng.random()}".encode() for _ in range(rng.randint(0, 9))] for _ in "ab")
        (_, own), = S.blocks([before + shared + after], 8)
        keys |= {key for start, n, key, _ in own if start <= len(before) < start + n}
    assert len(keys) == 1


def test_texts_and_other_columns(docs):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(3, f"a {passage}\nb"), (2, f"{passage} c"), (1, f"  d {passage}"), (9, passage), (None, passage), (4, None), (5, "")]
    out = S.without_repeats(docs(rows))
    assert out.columns == docs(rows).columns
    assert {(r["doc_id"], r["text"]) for r in out.collect()} == {
        (3, "a b"), (2, "c"), (1, f"  d {passage}"), (9, ""), (None, passage), (4, None), (5, "")}
    assert out.where("repeat_spans <> 'x'").count() == 0
    runs = S.maximal_repeats(docs(rows)).select("doc", "start", "end").collect()
    assert {tuple(r) for r in runs} == {(3, 1, 61), (2, 0, 60), (9, 0, 60)}


def test_text_ids(spark):
    """Ids of other kinds are compared in their own order."""
    passage = " ".join(f"p{i}" for i in range(50))
    df = spark.createDataFrame([("b", passage), ("a", passage)], "name string, body string")
    out = S.without_repeats(df, "name", "body")
    assert {tuple(r) for r in out.collect()} == {("a", passage), ("b", "")}


def test_no_step_pairs_the_members_of_a_group(spark):
    """A passage in every document, in different surroundings: rows grow with the documents, not with their pairs."""
    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([(i, f"a{i} b{i} {passage} c{i}") for i in range(400)], "doc_id long, text string")
    found = S.repeats(df)
    assert found.count() == 399
    assert found.select(F.explode("spans")).count() <= 399 * 64


def test_whole_table_sql(spark, small):
    """The registered SQL gives the query's rows, names and types over the whole table."""
    import __spark_entry__ as entry_points
    from comparison import connect, differences
    name = "op12_substring_dedup"
    assert differences(entry_points.queries()[name](spark, small), connect(small), entry_points.oracle_sql()[name]) == []
