"""Blocks of benchmark items: built by tasks, bounded in size, whole in their windows."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from etalage.llm import contamination


@pytest.fixture
def items():
    rng = random.Random(8)
    word = lambda: f"w{rng.randint(0, 60)}"
    return [(1, " ".join(word() for _ in range(700))), (2, " ".join(word() for _ in range(13))), (3, "w1 W2"), (2, "w3"),
            (None, "w4 w5 w6"), (5, None), (6, " ... "), *[(10 + i, " ".join(word() for _ in range(20))) for i in range(30)]]


def automata(uris):
    contamination._automaton.cache_clear()
    return [contamination._automaton(u) for u in uris]


def test_blocks_are_bounded(spark, items):
    """A long item is spread over blocks, and no block has more than its words, a piece and the overlaps."""
    bench = spark.createDataFrame(items, "item_id long, text string")
    made = automata(contamination.blocks(bench, block_words=100))
    assert len(made) > 8
    assert max(len(a.next) for a in made) <= 2 * (100 + 2 * (100 + 12)) + 1
    assert contamination.blocks(bench.where("false")) == []
    assert contamination.blocks(bench.where("item_id in (5, 6)")) == []


def test_windows_of_cut_items_stay_whole(spark, items):
    """Each window of an item is found, wherever the item was cut."""
    words = items[0][1].split()
    documents = [(i, " ".join(words[i:i + 13])) for i in range(0, 688, 3)] + [(9000, " ".join(words[5:17])), (9001, "w3 x"), (None, "w4 w5 W6")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(documents, "doc_id long, text string")
    out, name = contamination.matched(df, bench, block_words=50)
    m = F.col(name)
    got = [tuple(r) for r in out.select("doc_id", m["n_words"], contamination.n_hit(m), F.size(m["items"]),
                                        F.sha2(F.array_join(m["items"], ","), 256), contamination.contaminated(m)).collect()]
    assert sorted(got, key=str) == sorted(brute.contamination(documents, items), key=str)


def test_a_worker_holds_one_block():
    assert contamination._automaton.cache_info().maxsize == 1
