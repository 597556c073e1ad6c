"""The Merkle manifest: layout, storeys, proofs."""

import hashlib
import random

import brute
import pytest
from pyspark.sql import functions as F

from etalage.llm import merkle


@pytest.mark.parametrize("levels", range(1, 12))
def test_addresses_are_a_permutation(levels):
    places = [int(x) for depth in merkle.addresses(levels) for x in depth]
    assert sorted(places) == list(range(2 ** levels - 1))


def test_subtrees_lie_together():
    """Van Emde Boas: the upper half of the levels first, then each lower subtree in one piece, laid out alike."""
    levels = 11
    upper, lower = levels // 2, levels - levels // 2
    places = merkle.addresses(levels)
    assert sorted(int(x) for d in places[:upper] for x in d) == list(range(2 ** upper - 1))
    for tree in range(2 ** upper):
        base = 2 ** upper - 1 + tree * (2 ** lower - 1)
        for depth in range(lower):
            own = places[upper + depth][tree << depth:(tree + 1) << depth]
            assert (own - base == merkle.addresses(lower)[depth]).all()


def leaves_of(n, seed=0):
    rng = random.Random(seed)
    return [hashlib.sha256(rng.randbytes(8)).digest() for _ in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 31, 32])
def test_siblings_fold_to_the_root(n):
    own = leaves_of(n)
    for height in {(n - 1).bit_length(), 5}:
        tree = merkle.Subtree.build(own, height)
        for i, leaf in enumerate(own):
            path = list(tree.siblings(i))
            assert merkle.unpacked(merkle.packed(path)) == path
            assert merkle.fold(leaf, path) == tree.root()
            assert merkle.fold(leaves_of(1, 9)[0], path) != tree.root()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(i, rng.choice(["a", None]), rng.choice([None, "", "de", "en", "en", "en", "Ä", "z"]), rng.choice([None, i]), f"text {i}")
           for i in range(300)]
    return out + out[:5] + [(None, None, None, None, None)] * 2 + [(7, "s", "en", 1, ""), (8, "s", "alone", 1, "")]


@pytest.mark.parametrize("height", [1, 2, 3, 10])
def test_storeys(spark, rows, height):
    """However low the stored subtrees are, roots and proofs are those of the whole tree."""
    want = {(r[0], r[1], r[2], r[3], r[4]) for r in brute.manifest(rows)}
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaves = df.select("doc_id", "lang", merkle.leaf_digest([F.col(c) for c in fields]).alias("digest"))
    made = merkle.Manifest(leaves, "lang", ["doc_id"], ["doc_id"], height)
    found = made.proofs().withColumn("p", merkle.proved("digest", "path"))
    assert found.where("p.root <> root").count() == 0
    got = {(r["doc_id"], *(bytes(r[c]).hex() for c in ("digest", "subroot", "root")), bytes(r["proof"]).hex())
           for r in found.select("doc_id", "digest", "subroot", "root", "p.proof").collect()}
    assert got == want and found.count() == len(rows)
    assert [bytes(r["root"]).hex() for r in made.root().collect()] == list({w[3] for w in want})
    stored = made.groups.table()
    assert stored.where(F.col("leaves") > (1 << height)).count() == 0
    assert stored.where(F.octet_length("store") != 32 * ((2 * F.expr("shiftleft(1, height)")) - 1)).count() == 0
    if height == 2:
        assert stored.agg(F.max("storey")).first()[0] >= 3


def test_any_table(spark):
    """Other names, kinds of id and extra columns."""
    df = spark.createDataFrame([("b", None, 1), ("a", "x", 2), (None, "x", 3)], "key string, part string, g int")
    leaves = df.withColumn("digest", merkle.leaf_digest([F.col("key"), F.col("g")])).withColumn("pos", F.lit(-1))
    made = merkle.Manifest(leaves, "part", ["key"], ["key"])
    assert made.proofs().where(merkle.proved("digest", "path")["root"] == F.col("root")).count() == 3
    none = merkle.Manifest(leaves.where("false"), "part", ["key"], ["key"])
    assert none.proofs().count() == 0 and none.root().count() == 0
