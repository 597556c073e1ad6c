"""A Merkle manifest of a dataset, stored in van Emde Boas order.

Leaves are numbered per group by range partitions and the partitions' counts.  Every 2^10 consecutive leaves form an
aligned subtree, which one task hashes and stores as one array of digests: the upper half of the levels first, then the
subtrees below it from left to right, each laid out alike.  The address of a node follows from its level and number by
arithmetic, so building a subtree and collecting the siblings of a leaf touch few cache lines at any line size.
The roots of the subtrees are the leaves of the next storey, where the same is done again, until one root is left; the
roots of the groups are the leaves of one more tree.

A node is the hash of the hex digests of its children.  The last node of a level may have one child only; it
is hashed alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from etalage.llm.common import on_arrow, written
from etalage.operators.ranking import global_row_number

HEIGHT = 10  # levels above the leaves of a stored subtree: 2,047 digests, 64 KB
DIGEST = 32


# Layout --------------------------------------------------------------------------------------------------------------

def address(levels: int, depth: int, number: int) -> int:
    """Place of a node in a complete tree of so many levels, the root at depth 0."""
    at = 0
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
        else:
            lower = levels - upper
            depth -= upper
            tree, number = number >> depth, number & ((1 << depth) - 1)
            at += (1 << upper) - 1 + tree * ((1 << lower) - 1)
            levels = lower
    return at


@lru_cache(maxsize=None)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """``address`` of all nodes, one array per depth."""
    return tuple(np.array([address(levels, d, i) for i in range(1 << d)], np.int64) for d in range(levels))


def node(*children: bytes) -> bytes:
    """The digest over the children's hex digests."""
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


class Subtree:
    """A stored subtree over 1 to 2^height leaves."""

    def __init__(self, height: int, leaves: int, store: bytearray | bytes):
        self.height, self.leaves, self.store = height, leaves, store
        self.places = addresses(height + 1)

    @classmethod
    def build(cls, leaves: list[bytes], height: int) -> Subtree:
        """All nodes; beyond the last leaf the store stays zero."""
        tree = cls(height, len(leaves), bytearray(DIGEST * ((2 << height) - 1)))
        level = leaves
        tree._put(height, level)
        for depth in range(height - 1, -1, -1):
            level = [node(*level[i:i + 2]) for i in range(0, len(level), 2)]
            tree._put(depth, level)
        return tree

    def _put(self, depth: int, level: list[bytes]) -> None:
        for digest, at in zip(level, self.places[depth].tolist()):
            self.store[DIGEST * at:DIGEST * (at + 1)] = digest

    def get(self, depth: int, number: int) -> bytes:
        at = DIGEST * int(self.places[depth][number])
        return bytes(self.store[at:at + DIGEST])

    def root(self) -> bytes:
        return self.get(0, 0)

    def siblings(self, leaf: int) -> Iterator[tuple[bytes, bool]]:
        """(sibling, whether it stands on the left) from the leaf upwards; an empty sibling where there is none."""
        number, width = leaf, self.leaves
        for depth in range(self.height, 0, -1):
            other = number ^ 1
            yield (self.get(depth, other) if other < width else b""), bool(number & 1)
            number, width = number >> 1, (width + 1) >> 1


def fold(digest: bytes, path: Iterator[tuple[bytes, bool]]) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for sibling, left in path:
        digest = node(sibling, digest) if sibling and left else node(digest, sibling) if sibling else node(digest)
    return digest


def packed(path: list[tuple[bytes, bool]]) -> bytes:
    """A path as bytes: per step one byte (0: no sibling, 1: on the right, 2: on the left) and the sibling."""
    return b"".join(bytes([2 if left else 1]) + sibling if sibling else b"\0" for sibling, left in path)


def unpacked(path: bytes) -> list[tuple[bytes, bool]]:
    out, at = [], 0
    while at < len(path):
        size = DIGEST if path[at] else 0
        out.append((path[at + 1:at + 1 + size], path[at] == 2))
        at += 1 + size
    return out


# Construction --------------------------------------------------------------------------------------------------------

def _subtrees(height: int):
    def built(totals: pa.Array, blocks: pa.Array) -> pa.Array:
        """The stored subtrees of lists of digests.

        A subtree that is its whole tree is as high as its leaves need, any other has the full height.
        """
        heights, stores, roots = [], [], []
        for total, leaves in zip(totals.to_pylist(), blocks.to_pylist()):
            own = Subtree.build(leaves, (len(leaves) - 1).bit_length() if total <= 1 << height else height)
            heights.append(own.height)
            stores.append(bytes(own.store))
            roots.append(own.root())
        return pa.StructArray.from_arrays([pa.array(heights, pa.int32()), pa.array(stores, pa.binary()), pa.array(roots, pa.binary())],
                                          ["height", "store", "root"])

    return on_arrow(built, "height int, store binary, root binary")


def _paths(heights: pa.Array, leaves: pa.Array, stores: pa.Array, above: pa.Array) -> pa.Array:
    """For each stored subtree the paths of all its leaves, followed by the path of its root."""
    out = []
    for h, n, store, upper in zip(heights.to_pylist(), leaves.to_pylist(), stores.to_pylist(), above.to_pylist()):
        own = Subtree(h, n, store)
        out.append([packed(list(own.siblings(i))) + upper for i in range(n)])
    return pa.array(out, pa.list_(pa.binary()))


_paths_of = on_arrow(_paths, "array<binary>")


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` (g, ...) with ``pos``, the place of each row in its group g from 0, and ``total``, the group's rows.

    Nulls come first.  Rows that are equal in group and order keep the order in which they were written.
    """
    own = written(df.withColumn("tie", F.monotonically_increasing_id()), "manifest-input")
    keys = [F.asc_nulls_first(c) for c in ["g", *order, "tie"]]
    ranked = global_row_number(own, keys, "rank", written=True)
    bounds = written(ranked.groupBy("g").agg(F.min("rank").alias("first"), F.count("*").alias("total")), "manifest-groups")
    return ranked.join(bounds, "g").withColumn("pos", F.col("rank") - F.col("first")).drop("tie", "rank", "first")


class Forest:
    """The trees of all groups of numbered leaves (g, pos, total, digest, ...), stored storey by storey."""

    def __init__(self, leaves: DataFrame, carried: list[str], height: int = HEIGHT):
        self.size, self.carried, self.storeys = 1 << height, carried, []
        while True:
            row = F.struct("pos", "digest", *(carried if not self.storeys else []))
            blocks = (leaves.withColumn("block", F.floor(F.col("pos") / self.size)).groupBy("g", "block")
                      .agg(F.max("total").alias("total"), F.sort_array(F.collect_list(row)).alias("rows")))
            built = blocks.withColumn("tree", _subtrees(height)(F.col("total"), F.col("rows.digest")))
            self.storeys.append(written(built.select("g", "block", "total", "rows", "tree.*"), "manifest-storey", compression="zstd"))
            rest = self.storeys[-1].where(F.col("total") > self.size)
            if not rest.head(1):
                break
            leaves = rest.select("g", F.col("block").alias("pos"), F.ceil(F.col("total") / self.size).alias("total"),
                                 F.col("root").alias("digest"))

    def table(self) -> DataFrame:
        """One row per stored subtree: (storey, g, block, leaves, height, store, root)."""
        return _union([s.select(F.lit(i).alias("storey"), "g", "block", F.size("rows").alias("leaves"), "height", "store", "root")
                       for i, s in enumerate(self.storeys)])

    def roots(self) -> DataFrame:
        """(g, digest): the root of every group."""
        return _union([s.where(F.col("total") <= self.size).select("g", F.col("root").alias("digest")) for s in self.storeys])

    def paths(self, above: DataFrame) -> DataFrame:
        """(g, pos, digest, path, carried) of every leaf; ``above`` (g, path) holds the paths that go on from the roots."""
        found = None
        for i in reversed(range(len(self.storeys))):
            stored, ends = self.storeys[i], F.col("total") <= self.size
            known = stored.where(ends).join(above.withColumnRenamed("path", "above"), "g")
            if found is not None:
                upper = written(found.select("g", F.col("pos").alias("block"), F.col("path").alias("above")), "manifest-paths")
                known = known.unionByName(stored.where(~ends).join(upper, ["g", "block"]))
            paths = _paths_of(F.col("height"), F.size("rows"), F.col("store"), F.col("above"))
            found = (known.select("g", "rows", paths.alias("paths")).select("g", F.explode(F.arrays_zip("rows", "paths")).alias("z"))
                     .select("g", "z.rows.*", F.col("z.paths").alias("path")))
        return found


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Manifest of a table -------------------------------------------------------------------------------------------------

def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 over the values one after the other: ``-`` for null, else byte count, ``:`` and value."""
    texts = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hex_digest(digest: Column) -> Column:
    return F.lower(F.hex(digest))


class Manifest:
    """Trees per group and one over their roots, for a table with a digest per row.

    ``df`` has columns ``digest`` (binary) and ``names``, which are carried along; ``group`` is a text column, whose
    nulls form the first group.  Rows of a group ascend by ``order`` (nulls first), then by digest; repeated rows are
    leaves of their own.  An empty table has no root.
    """

    def __init__(self, df: DataFrame, group: str, order: list[str], names: list[str], height: int = HEIGHT):
        # Null comes before all texts, so that groups sort by their bytes alone.
        g = F.when(F.col(f"`{group}`").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(f"`{group}`")))
        slim = df.select(g.alias("g"), "digest", *[F.col(f"`{c}`") for c in dict.fromkeys([*order, *names])])
        self.groups = Forest(numbered(slim, [*order, "digest"]), names, height)
        tops = self.groups.roots().select(F.lit("").alias("g"), F.col("g").alias("of"), "digest")
        self.top = Forest(numbered(tops, ["of"]), ["of"], height)

    def root(self) -> DataFrame:
        """One row, one column ``root``; none for an empty table."""
        return self.top.roots().select(F.col("digest").alias("root"))

    def proofs(self) -> DataFrame:
        """Each leaf with its names, ``digest``, ``path`` to the root, ``subroot`` of its group, and ``root``."""
        ends = self.top.roots().select("g", F.lit(b"").alias("path"), F.col("digest").alias("root"))
        tops = (self.top.paths(ends.select("g", "path")).join(ends.select("g", "root"), "g")
                .select(F.col("of").alias("g"), F.col("digest").alias("subroot"), "path", "root"))
        tops = written(tops, "manifest-tops")
        return self.groups.paths(tops.select("g", "path")).join(tops.select("g", "subroot", "root"), "g")


def _proved(digests: pa.Array, paths: pa.Array) -> pa.Array:
    proofs, roots = [], []
    for digest, path in zip(digests.to_pylist(), paths.to_pylist()):
        steps = unpacked(path)
        proofs.append(node(*[sibling for sibling, _ in steps if sibling]))
        roots.append(fold(digest, steps))
    return pa.StructArray.from_arrays([pa.array(proofs, pa.binary()), pa.array(roots, pa.binary())], ["proof", "root"])


proved = on_arrow(_proved, "proof binary, root binary")
proved.__doc__ = "(leaf, path) to the digest over all siblings and the root that follows from the leaf."


def manifest_query(spark, folder: str) -> DataFrame:
    """Rows of a language with equal ids ascend by their leaves.  A row without an id is not tampered with."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = docs.select("doc_id", "lang", leaf_digest([F.col(c) for c in fields]).alias("digest"),
                         F.when(tampered & F.col("n_chars").isNotNull(),
                                leaf_digest([more if c == "n_chars" else F.col(c) for c in fields])).alias("found"))
    proofs = Manifest(leaves, "lang", ["doc_id"], ["doc_id", "found"]).proofs()
    out = proofs.withColumn("p", proved(F.coalesce("found", "digest"), F.col("path")))
    return out.select("doc_id", hex_digest(F.col("digest")).alias("leaf"), hex_digest(F.col("subroot")).alias("subroot"),
                      hex_digest(F.col("root")).alias("root"), hex_digest(F.col("p.proof")).alias("proof_sha256"),
                      hex_digest(F.col("p.root")).alias("folded_root"), (F.col("p.root") == F.col("root")).alias("verified"))
