"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are cut into parts of up to 16 bits, strongly correlated bits in the same part.  If two
fingerprints differ in at most ``tau`` bits, then for any thresholds t_1..t_m >= -1 that sum to
``tau - m + 1`` some part i differs in at most t_i bits (-1: the part is not looked at).  For every distinct
fingerprint a dynamic program picks the thresholds with the least estimated work, from exact counts of the
part values; it then probes all values within t_i bits, and what it meets is verified on all 64 bits.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from etalage.llm.common import fresh, per_text, written
from etalage.llm.components import components

WORDS = 3
SEED = 42
TAU = 3
PARTS = 4
BUCKET_ROWS = 4096
PROBE_COST = 100
_CHUNK = 1 << 16
_CELLS = 1 << 22


def fingerprint(text: bytes) -> int:
    """Signed 64-bit majority of the XXH64 values of all three-word shingles; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - WORDS + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        part = words[at:at + _CHUNK + WORDS - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        last = ends[min(WORDS, len(part)) - 1:].tolist()
        first = [0, *(ends + 1).tolist()][:len(last)]
        h = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(first, last)], np.uint64, len(last))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view(np.int64)[0])


_fingerprint = per_text(lambda t: (fingerprint(t),), {"fp": pa.int64()}, "fp long")


# Parts and thresholds ----------------------------------------------------------------------------------------------

def _bit_matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((64, 64), np.int64)
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        for at in range(0, len(bits), _CHUNK):
            total += (bits[at:at + _CHUNK].T @ bits[at:at + _CHUNK]).astype(np.int64)
    i, j = np.triu_indices(64)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "n"])


def correlated_parts(fps: DataFrame, parts: int = PARTS) -> list[list[int]]:
    """Bits in ``parts`` groups of equal size; each group grows by the bit that correlates most with it.

    The 64 x 64 counts are sums over all fingerprints; only they reach the driver.
    """
    rows = fps.mapInArrow(_bit_matrix, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    n = max(fps.count(), 1)
    both = np.zeros((64, 64))
    for r in rows:
        both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["n"] / n
    p = both.diagonal()
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both - np.outer(p, p)) / np.outer(sd, sd)
    left, groups = list(range(64)), []
    for k in range(parts, 0, -1):
        size = math.ceil(len(left) / k)
        group = [left.pop(0)]
        while len(group) < size:
            best = max(left, key=lambda b: (round(float(corr[b, group].sum()), 9), -b))
            left.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def part_value(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for k, b in enumerate(bits):
        out |= ((fps >> b) & 1) << k
    return out


def _part_values(groups: list[list[int]]):
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(groups)), len(fps))),
                 pa.array(np.concatenate([part_value(fps, g) for g in groups]))], names=["part", "value"])

    return values


def near_counts(fps: DataFrame, groups: list[list[int]], tau: int = TAU) -> list[np.ndarray]:
    """For each part an array [e, v]: fingerprints whose value there is within e bits of v.

    At most 2^16 counts a part reach the driver, however many fingerprints there are.
    """
    counted = (fps.mapInArrow(_part_values(groups), "part long, value long")
               .groupBy("part", "value").agg(F.count("*").alias("n")).toArrow())
    part, value, n = (counted.column(c).to_numpy() for c in ("part", "value", "n"))
    out = []
    for i, bits in enumerate(groups):
        exact = np.zeros(1 << len(bits), np.int64)
        exact[value[part == i]] = n[part == i]
        out.append(np.cumsum(_at_distance(exact, len(bits), tau), axis=0))
    return out


def _at_distance(counts: np.ndarray, width: int, tau: int) -> np.ndarray:
    """[e, v]: the count of values exactly e bits from v, one bit after the other."""
    at = np.zeros((tau + 1, len(counts)), np.int64)
    at[0] = counts
    index = np.arange(len(counts))
    for b in range(width):
        at[1:] += at[:-1][:, index ^ (1 << b)]
    return at


def allocate(fps: np.ndarray, groups: list[list[int]], near: list[np.ndarray], tau: int = TAU) -> np.ndarray:
    """[fingerprint, part] thresholds with the least estimated cost, by dynamic programming over the parts.

    The cost of threshold e in a part is its number of probed values times ``PROBE_COST`` plus the
    fingerprints it will meet.  State s is the sum so far of (threshold + 1); the sum over all is tau + 1.
    """
    total = tau + 1
    best = np.full((total + 1, len(fps)), np.inf)
    best[0] = 0
    picks = []
    for bits, counts in zip(groups, near):
        values = part_value(fps, bits)
        cost = [np.zeros(len(fps))]
        for e in range(tau + 1):
            probes = sum(math.comb(len(bits), k) for k in range(e + 1))
            cost.append(counts[e][values] + PROBE_COST * probes)
        step = np.full_like(best, np.inf)
        pick = np.zeros(best.shape, np.int8)
        for s in range(total + 1):
            for up in range(s + 1):
                c = best[s - up] + cost[up]
                better = c < step[s]
                step[s][better], pick[s][better] = c[better], up
        best = step
        picks.append(pick)
    out = np.empty((len(fps), len(groups)), np.int64)
    state, rows = np.full(len(fps), total), np.arange(len(fps))
    for i in range(len(groups) - 1, -1, -1):
        up = picks[i][state, rows].astype(np.int64)
        out[:, i], state = up - 1, state - up
    return out


def _masks(width: int, tau: int) -> list[np.ndarray]:
    """The masks of exactly e bits, for e from 0 to tau."""
    return [np.array([sum(1 << b for b in c) for c in itertools.combinations(range(width), e)], np.int64)
            for e in range(tau + 1)]


INDEXED, PROBE = 1, 2


def _entries(groups: list[list[int]], near, tau: int):
    """Rows (part, value, fp, kind): each fingerprint under its own values, and under those it probes."""
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = near.value
        masks = [_masks(len(g), tau) for g in groups]
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            t = allocate(fps, groups, counts, tau)
            for i, bits in enumerate(groups):
                values = part_value(fps, bits)
                kind = np.where(t[:, i] >= 0, INDEXED | PROBE, INDEXED)
                yield _entry_batch(i, values, fps, kind)
                for e in range(1, tau + 1):
                    far = t[:, i] >= e
                    if far.any():
                        v = (values[far][:, None] ^ masks[i][e]).ravel()
                        yield _entry_batch(i, v, np.repeat(fps[far], len(masks[i][e])), np.full(len(v), PROBE))

    return entries


def _entry_batch(part: int, values, fps, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(fps), part, np.int32)), pa.array(values.astype(np.int32)), pa.array(fps),
         pa.array(kind.astype(np.int32))], names=["part", "value", "fp", "kind"])


# Verification ------------------------------------------------------------------------------------------------------

def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) reduced to one link per node, to the smallest node that they connect it with."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all() and (label[x] == label[y]).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits; unsigned, as numpy counts the bits of a negative number's absolute value."""
    return np.bitwise_count((x ^ y).view(np.uint64))


def _small_buckets(bucket, fps, kind, tau):
    """Links within buckets of few members, by comparing all members with the k-th after them."""
    found = []
    size = int(np.bincount(bucket).max())
    for k in range(1, size):
        same = bucket[k:] == bucket[:-k]
        if not same.any():
            break
        i = np.flatnonzero(same)
        probed = ((kind[i] & PROBE) & ((kind[i + k] & INDEXED) << 1)) | ((kind[i + k] & PROBE) & ((kind[i] & INDEXED) << 1))
        i = i[(probed > 0) & (_apart(fps[i], fps[i + k]) <= tau)]
        found.append((fps[i], fps[i + k]))
    return found


def _large_bucket(fps, block, tau):
    """Links that connect what is connected in one bucket, by a search from member to member.

    Every member is compared with those not reached yet, so a group of near copies costs little more than
    one pass, and at most one link a member comes out.
    """
    found = []
    tiles = np.unique(block)
    if len(tiles) > 1:  # two blocks of a split bucket: links between the blocks only
        x, y = fps[block == tiles[0]], fps[block == tiles[1]]
        step = max(1, _CELLS // len(y))
        for at in range(0, len(x), step):
            i, j = np.nonzero(_apart(x[at:at + step, None], y[None, :]) <= tau)
            found.append(spanning(x[at:at + step][i], y[j]))
        return found
    rest = fps
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            step = max(1, _CELLS // len(rest))
            here, front = front[:step], front[step:]
            near = _apart(here[:, None], rest[None, :]) <= tau
            hit = near.any(axis=0)
            if hit.any():
                found.append((here[near[:, hit].argmax(axis=0)], rest[hit]))
                front, rest = np.concatenate([front, rest[hit]]), rest[~hit]
    return found


def _verify(tau: int, small: int = 32):
    """Sorted entries of whole buckets in, links out; a bucket may span batches."""
    def links(part, value, tile, fps, kind, block) -> pa.RecordBatch | None:
        edge = np.flatnonzero((np.diff(part) != 0) | (np.diff(value) != 0) | (np.diff(tile) != 0)) + 1
        starts = np.concatenate([[0], edge])
        sizes = np.diff(np.concatenate([starts, [len(fps)]]))
        bucket = np.repeat(np.arange(len(starts)), sizes)
        few = (sizes > 1) & (sizes <= small)
        pick = few[bucket]
        found = _small_buckets(bucket[pick], fps[pick], kind[pick], tau) if few.any() else []
        for k in np.flatnonzero(sizes > small):
            rows = slice(starts[k], starts[k] + sizes[k])
            found += _large_bucket(fps[rows], block[rows], tau)
        if not sum(len(x) for x, _ in found):
            return None
        a, b = spanning(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(6)]
            kept = new if kept is None else [np.concatenate(x) for x in zip(kept, new)]
            last = (kept[0] == kept[0][-1]) & (kept[1] == kept[1][-1]) & (kept[2] == kept[2][-1])
            cut = int(np.argmax(last))
            if cut:
                out = links(*[x[:cut] for x in kept])
                kept = [x[cut:] for x in kept]
                if out is not None:
                    yield out
        if kept is not None and len(kept[0]):
            out = links(*kept)
            if out is not None:
                yield out

    return verify


def links(fps: DataFrame, tau: int = TAU, parts: int = PARTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints (one column) that connect all within ``tau`` bits.

    Not every linked pair is listed, but whatever is linked is connected.  A bucket of more than
    ``bucket_rows`` entries is dealt out in blocks, and each pair of blocks is one unit of work.
    """
    spark = fps.sparkSession
    groups = correlated_parts(fps, parts)
    near = spark.sparkContext.broadcast(near_counts(fps, groups, tau))
    entries = fps.mapInArrow(_entries(groups, near, tau), "part int, value int, fp long, kind int")
    entries = written(entries, "simhash-entries")
    hot = written(entries.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows)
                  .select("part", "value", F.ceil(F.col("n") / bucket_rows).cast("int").alias("blocks")), "hot-buckets")
    dealt = entries.join(hot, ["part", "value"], "left")
    block = F.when(F.col("blocks").isNull(), F.lit(-1)).otherwise(F.expr("pmod(xxhash64(fp), blocks)")).cast("int")
    dealt = dealt.withColumn("block", block)
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0)))
                      .otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("other", other)
    tile = F.when(F.col("blocks").isNull(), F.lit(-1)).otherwise(
        F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
    dealt = dealt.select("part", "value", tile.cast("int").alias("tile"), "fp", "kind", "block")
    sorted_ = dealt.repartition("part", "value", "tile").sortWithinPartitions("part", "value", "tile", "fp")
    return sorted_.mapInArrow(_verify(tau), "a long, b long")


def near_groups(docs: DataFrame, fp: str, doc_id: str, tau: int = TAU, parts: int = PARTS,
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(fp, component): for every distinct fingerprint the smallest document id reachable over links.

    Null ids are never the smallest; a component of null ids only has a null one.
    """
    classes = written(docs.groupBy(F.col(f"`{fp}`").alias("fp")).agg(F.min(F.col(f"`{doc_id}`")).alias("least")),
                      "simhash-classes")
    linked = written(components(links(classes.select("fp"), tau, parts, bucket_rows), "a", "b"), "simhash-components")
    rooted = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.join(roots, "root").select("fp", "component")


def _prints(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, body, fp): the id, a 64-bit digest of the text and its fingerprint, written once."""
    t = F.col(f"`{text}`")
    return written(df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(t).alias("body"),
                             _fingerprint(t)["fp"].alias("fp")), "fingerprints")


def simhash_components(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, body, fp, component) per row of ``df``; null texts count as empty, repeated rows stay repeated."""
    prints = _prints(df, doc_id, text)
    return prints.join(written(near_groups(prints, "fp", "doc_id"), "near-groups"), "fp")


def keep_one_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group stays: the one with the smallest id, of repeated rows one.

    Null ids come last; equal ids are told apart by their fingerprints and text digests.
    """
    id_, t = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    prints = _prints(df, doc_id, text)
    classes = written(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body"))
                                               .alias("first")), "simhash-firsts")
    linked = written(components(links(classes.select("fp")), "a", "b"), "simhash-components")
    rooted = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    firsts = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    keys = [fresh(df, c) for c in ("keep_id", "keep_none", "keep_body")]
    number = fresh(df, "keep_number")
    survivors = written(firsts.select(F.coalesce(F.col("first.doc_id").cast("string"), F.lit("")).alias(keys[0]),
                                      F.col("first.none").alias(keys[1]), F.col("first.body").alias(keys[2])), "survivors")
    # Numbering by the join's own keys: repeated rows are cut to one per task before the one shuffle of the texts.
    rows = (df.withColumn(keys[0], F.coalesce(id_.cast("string"), F.lit(""))).withColumn(keys[1], id_.isNull())
            .withColumn(keys[2], F.xxhash64(t))
            .withColumn(number, F.row_number().over(Window.partitionBy(*keys).orderBy(keys[2])))
            .where(F.col(number) == 1))
    return rows.join(survivors, keys, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


def simhash_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return simhash_components(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                           F.col("component").alias("component_id"))
