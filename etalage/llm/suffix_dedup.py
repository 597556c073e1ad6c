"""Removal of repeated byte strings, by sorting the suffixes at anchors in groups of equal beginnings.

No shard orders its suffixes and no Burrows-Wheeler transform is built, so no shards' orders are merged: an order of
all suffixes, or one merged transform, cannot be split into bounded tasks.  Hash-grouped anchors, sorted within each
group, stand in for them; the result is the same.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else.  Every such string holds an
*anchor* (a k-gram whose hash is the least in some window of w k-grams) at most w-1 bytes from its start, and
its copies hold one at the same place.  So the suffixes that have to be ordered are those at anchors:

1. Every document lists its anchors with a hash of the bytes that follow.  Suffixes whose beginning occurs once are
   done; the others form groups by that hash, in no order among each other.
   Equal surroundings (up to w-1 bytes before, ``length`` bytes after) are one entry with a count.
2. The entries of a group arrive unordered and are sorted from scratch in one task, by a radix sort with symbols of
   eight bytes: in every round each interval of equal beginnings is sorted by the next symbol; settled intervals are
   left alone.  The round in which two neighbours part gives their common prefix.  The strings before the anchors
   are sorted alike, backwards.
3. For each distance d of the start from the anchor, the intervals with common prefixes of ``length`` - d and
   common preceding strings of d bytes are the repeated ones.

A group of more than ``group_rows`` entries (a passage that very many documents share) is cut by d into halves,
whose entries are grouped anew by all bytes that their strings have in common, until groups are small or d is
one number and the count alone decides.  Of entries that are equal in all that a half can see one goes on, so a
group that is solved has ``group_rows`` rows at most.  No group is ever compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from etalage.llm.common import fresh, on_arrow, sha256_hex, utf8, written

LENGTH = 400
GROUP_ROWS = 16_384  # about 11 MB of surroundings in one task
_SEGMENT = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


def shape(length: int) -> tuple[int, int]:
    """Width w of the windows and size k of the k-grams: w + k - 1 <= length."""
    w = max(1, length * 5 // 8)
    return w, max(1, min(16, length - w))


# Anchors -------------------------------------------------------------------------------------------------------------

def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k-gram, from those of its halves."""
    if k == 1:
        return data.astype(np.uint64) + np.uint64(1)
    if k % 2:
        less = _gram_hashes(data[:-1], k - 1)
        return less * _BASE + data[k - 1:] + np.uint64(1)
    half = _gram_hashes(data, k // 2)
    factor = np.uint64(pow(int(_BASE), k // 2, 1 << 64))
    return half[:len(half) - k // 2] * factor + half[k // 2:]


def _sliding(values: np.ndarray, w: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) over every w neighbours."""
    out, size = values, 1
    while 2 * size <= w:
        out, size = take(out[:len(out) - size], out[size:]), 2 * size
    return take(out[:len(out) - (w - size)], out[w - size:]) if size < w else out


def anchors(text: bytes, w: int, k: int) -> np.ndarray:
    """Starts of the k-grams that have the least hash in some window of w; all of equal ones."""
    found = []
    for start in range(0, max(len(text) - k + 1, 0), _SEGMENT):
        low = max(0, start - w + 1)
        data = np.frombuffer(text, np.uint8)[low:start + _SEGMENT + w + k]
        if len(data) < w + k - 1:
            data = np.frombuffer(text, np.uint8)[(low := max(0, len(text) - w - k - _SEGMENT)):]
            if len(data) < w + k - 1:
                break
        h = _gram_hashes(data, k)
        h = (((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32)
        least = _sliding(h, w, np.minimum)
        padded = np.zeros(len(least) + 2 * (w - 1), np.uint32)
        padded[w - 1:w - 1 + len(least)] = least
        at = np.flatnonzero(_sliding(padded, w, np.maximum) == h) + low
        found.append(at[(at >= start) & (at < start + _SEGMENT)])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _anchor_rows(length: int):
    w, k = shape(length)
    after = length - w + 1

    def batch(texts: pa.Array) -> pa.Array:
        """Anchors in reach of a whole string, with hashes of what follows and of all around."""
        places, keys, digs, ends = [], [], [], [0]
        for t in utf8(texts):
            if t is not None and len(t) >= length:
                at = anchors(t, w, k)
                for x in at[len(t) - at >= after].tolist():
                    left = min(x, w - 1)
                    places.append(x)
                    keys.append(xxhash.xxh3_64_intdigest(t[x:x + after]) - (1 << 63))
                    digs.append(xxhash.xxh3_64_intdigest(t[x - left:x + length], left) - (1 << 63))
            ends.append(len(places))
        rows = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (places, keys, digs)], ["at", "key", "dig"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return on_arrow(batch, "array<struct<at: long, key: long, dig: long>>")


# Sorting -------------------------------------------------------------------------------------------------------------

def _words(strings: list[bytes], size: int) -> np.ndarray:
    """The strings as rows of big-endian 64-bit symbols, filled up with zeros."""
    width = -(-size // 8) * 8
    return np.frombuffer(b"".join(s[:size].ljust(width, b"\0") for s in strings), ">u8").reshape(len(strings), -1).astype(np.uint64)


def _common_bytes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Leading bytes that differing symbols share."""
    diff = x ^ y
    same = np.zeros(len(x), np.int64)
    for b in range(7):
        same += (diff >> np.uint64(8 * (7 - b))) == 0
    return same


def interleave(symbols: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the entries of each group, by a radix sort, and the common prefix of each with the one before it.

    ``group`` is in ascending order.  -1 stands where a group begins.
    """
    n = len(group)
    order = np.arange(n)
    prefix = np.full(n, 8 * symbols.shape[1], np.int64)
    begins = np.concatenate([[True], group[1:] != group[:-1]])
    prefix[begins] = -1
    for k in range(symbols.shape[1]):
        interval = np.cumsum(begins) - 1
        sizes = np.bincount(interval)
        open_ = np.flatnonzero(sizes[interval] > 1)
        if not len(open_):
            break
        mine, col = interval[open_], symbols[order[open_], k]
        turn = np.lexsort((col, mine))
        order[open_] = order[open_][turn]
        col = col[turn]
        part = np.flatnonzero((mine[1:] == mine[:-1]) & (col[1:] != col[:-1])) + 1
        prefix[open_[part]] = 8 * k + _common_bytes(col[part], col[part - 1])
        begins[open_[part]] = True
    return order, prefix


def repeated(group: np.ndarray, left: list[bytes], right: list[bytes], low: np.ndarray, high: np.ndarray,
             length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the least and greatest distance d at which its string occurs at another entry; -1: at none.

    ``left`` holds the preceding bytes backwards, ``right`` those that follow; ``low`` and ``high`` bound d.
    """
    n = len(group)
    least, most = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    lefts, rights = (np.fromiter(map(len, x), np.int64, n) for x in (left, right))
    r_order, r_prefix = interleave(_words(right, length), group)
    l_order, l_prefix = interleave(_words(left, max(1, int(high.max()))), group)
    for d in range(int(low.min()), int(high.max()) + 1):
        fit = (lefts >= d) & (rights >= length - d) & (low <= d) & (d <= high)
        r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
        r_class[r_order] = np.cumsum(r_prefix < length - d)
        l_class[l_order] = np.cumsum(l_prefix < d) if d else group
        at = np.flatnonzero(fit)
        both = r_class[at] * (n + 1) + (l_class[at] if d else 0)
        turn = np.argsort(both, kind="stable")
        same = np.flatnonzero(both[turn][1:] == both[turn][:-1])
        hit = at[np.concatenate([turn[same], turn[same + 1]])]
        most[hit] = d
        least[hit] = np.where(least[hit] < 0, d, least[hit])
    return least, most


_SOLVED = "key long, dig long, reach_left long, reach_right long"


def _solve(length: int):
    """Sorted entries of whole groups in, how far the repeated strings reach from each anchor out."""
    def solved(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(rows)
        key, dig, low, high, name, wide = (t[c].to_numpy() for c in ("key", "dig", "low", "high", "name", "wide"))
        # One entry per distinct surroundings: those of a repeated document may come more than once.
        _, group = np.unique(name, return_inverse=True)
        first = np.concatenate([[True], (group[1:] != group[:-1]) | (wide[1:] != wide[:-1])])
        t, key, dig, low, high, group = t.filter(pa.array(first)), key[first], dig[first], low[first], high[first], group[first]
        least, most = repeated(group, t["before"].to_pylist(), t["after"].to_pylist(), low, high, length)
        hit = most >= 0
        if not hit.any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (key[hit], dig[hit], most[hit], length - least[hit])],
                                          names=["key", "dig", "reach_left", "reach_right"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("name").to_numpy(zero_copy_only=False)
            cut = int(np.argmax(names == names[-1]))  # the last group may go on in the next batch
            if cut or (held and held[-1].column("name")[-1].as_py() != names[-1]):
                out = solved([*held, batch.slice(0, cut)] if cut else held)
                held = [batch.slice(cut)]
                if out is not None:
                    yield out
            else:
                held.append(batch)
        if held and (out := solved(held)) is not None:
            yield out

    return solve


# Surroundings of anchors ---------------------------------------------------------------------------------------------

def _surroundings(length: int):
    w, _ = shape(length)

    def cut(texts: pa.Array, places: pa.Array) -> pa.Array:
        out = []
        for t, own in zip(utf8(texts), places.to_pylist()):
            out.append([{"key": p["key"], "dig": p["dig"], "large": p["large"],
                         "before": t[max(0, p["at"] - w + 1):p["at"]][::-1], "after": t[p["at"]:p["at"] + length]}
                        for p in own])
        struct = pa.struct([("key", pa.int64()), ("dig", pa.int64()), ("large", pa.bool_()), ("before", pa.binary()),
                            ("after", pa.binary())])
        return pa.array(out, pa.list_(struct))

    return on_arrow(cut, "array<struct<key: long, dig: long, large: boolean, before: binary, after: binary>>")


def _narrow(low: Column, high: Column, length: int) -> tuple[Column, Column, Column]:
    """Name of the group, digest of all around, and whether a string fits, for distances from low to high."""
    before, after = F.col("before"), F.col("after")
    common = F.concat(F.expr("substring(before, 1, low)"), F.expr(f"substring(after, 1, {length} - high)"))
    whole = F.concat(F.expr("substring(before, 1, high)"), F.expr(f"substring(after, 1, {length} - low)"))
    lefts, rights = F.octet_length(before), F.octet_length(after)
    fits = (lefts >= low) & (rights >= length - high) & (F.least(lefts, high) + F.least(rights, length - low) >= length)
    return (F.xxhash64("key", "low", common), F.xxhash64("name", F.least(lefts, high), whole), fits)


def _with_levels(entries: DataFrame, length: int) -> DataFrame:
    w, _ = shape(length)
    return entries.select("key", "dig", "large", "before", "after", F.lit(0).alias("low"), F.lit(w - 1).alias("high"),
                          F.col("key").alias("name"), F.col("dig").alias("wide"))


def _solved_groups(entries: DataFrame, length: int) -> DataFrame:
    """(key, dig, reach_left, reach_right) from whole groups of bounded size."""
    return (entries.select("key", "dig", "before", "after", "low", "high", "name", "wide").repartition("name")
            .sortWithinPartitions("name", "wide").mapInArrow(_solve(length), _SOLVED))


def _solved_large(entries: DataFrame, length: int, group_rows: int) -> DataFrame:
    """The same for groups too large for one task: cut by distance until they are not."""
    w, _ = shape(length)
    parts, size, entries = [], w, entries.withColumn("known", F.lit(False))
    while size > 1:
        size = -(-size // 2)
        low, high, middle = F.col("low"), F.col("high"), F.col("low") + F.lit(size)
        parts_of = F.when(middle <= high, F.array(F.struct(low.alias("low"), (middle - 1).alias("high")),
                                                  F.struct(middle.alias("low"), high.alias("high")))
                          ).otherwise(F.array(F.struct(low.alias("low"), high.alias("high"))))
        halves = (entries.select("key", "dig", "before", "after", "known", F.explode(parts_of).alias("d"))
                  .select("key", "dig", "before", "after", "known", "d.low", "d.high"))
        name, wide, fits = _narrow(low, high, length)
        halves = written(halves.withColumn("name", name).withColumn("wide", wide).where(fits), "halves")
        kinds = written(halves.groupBy("name", "wide").agg(F.count("*").alias("n"), F.min("dig").alias("dig"),
                                                           F.max("known").alias("known")), "kinds")
        lefts, rights = F.octet_length("before").cast("long"), F.octet_length("after").cast("long")
        ends = halves.select("name", "wide", "key", "dig", F.least(lefts, high).alias("reach_left"),
                             F.least(rights, length - low).alias("reach_right"))
        parts.append(ends.join(kinds.where("n > 1").select("name", "wide"), ["name", "wide"])
                     .select("key", "dig", "reach_left", "reach_right"))
        # Entries of one kind have no farther reach in any part of the range; one of them stays, for the others to meet.
        known = F.col("known") | (F.col("n") > 1)
        open_ = written(kinds.groupBy("name").agg(F.count("*").alias("kinds"), F.min(known).alias("settled"))
                        .where("kinds > 1 and not settled").select("name", (F.col("kinds") > group_rows).alias("large")),
                        "open-groups")
        kept = kinds.select("name", "wide", "dig", known.alias("known")).join(open_, "name")
        halves = written(halves.drop("known").join(kept, ["name", "wide", "dig"]), "open-halves")
        parts.append(_solved_groups(halves.where(~F.col("large")), length))
        entries = halves.where("large")
        if not entries.head(1):
            break
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("key", "dig").agg(F.max("reach_left").alias("reach_left"), F.max("reach_right").alias("reach_right"))


# Documents -----------------------------------------------------------------------------------------------------------

def _keyed(df: DataFrame, doc_id: str, text: str, names: list[str]) -> DataFrame:
    """``df`` with three columns that tell documents apart: id as text, whether it is null, digest of the text."""
    id_ = F.col(f"`{doc_id}`")
    return (df.withColumn(names[0], F.coalesce(id_.cast("string"), F.lit(""))).withColumn(names[1], id_.isNull())
            .withColumn(names[2], F.xxhash64(F.col(f"`{text}`"))))


_ID = ["doc", "none", "body"]


def repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
            group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc, none, body, spans): for each document the anchors in repeated strings, and how far they reach.

    A reach of -1 stands for all of the surroundings.
    """
    slim = _keyed(df.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")), "id", "text", _ID)
    listed = written(slim.select(*_ID, F.explode(_anchor_rows(length)(F.col("text"))).alias("a")).select(*_ID, "a.*"), "anchors")
    again = written(listed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeated-keys")
    open_ = written(listed.join(again, "key"), "repeated-anchors")
    classes = written(open_.groupBy("key", "dig").agg(F.count("*").alias("n"), F.min(F.struct(*_ID, "at")).alias("first")),
                      "surroundings")
    mixed = written(classes.groupBy("key").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
                    .where("kinds > 1 and least = 1").select("key", "kinds"), "mixed-groups")
    # One row of each document is enough; rows that repeat are cut to one per task before the shuffle.
    one = (slim.where(F.octet_length("text") >= length)
           .withColumn("row", F.row_number().over(Window.partitionBy(*_ID).orderBy("body"))).where("row = 1"))

    large = F.col("kinds") > group_rows
    places = (classes.join(mixed.select("key", large.alias("large")), "key").select("first.*", "key", "dig", "large")
              .groupBy(*_ID).agg(F.collect_list(F.struct("at", "key", "dig", "large")).alias("places")))
    found = one.join(written(places, "places"), _ID)
    found = found.select(F.explode(_surroundings(length)(F.col("text"), F.col("places"))).alias("e")).select("e.*")
    entries = written(_with_levels(found, length), "entries", compression="zstd")
    single = written(_solved_groups(entries.where(~F.col("large")), length), "reaches-small")
    if mixed.where(large).head(1):
        single = single.unionByName(_solved_large(entries.where("large"), length, group_rows))
    whole = classes.where("n > 1").select("key", "dig", F.lit(-1).cast("long").alias("reach_left"),
                                          F.lit(-1).cast("long").alias("reach_right"))
    once = classes.where("n = 1").select("key", "dig").join(single, ["key", "dig"])
    reach = written(whole.unionByName(once), "reaches")
    return (open_.distinct().join(reach, ["key", "dig"]).groupBy(*_ID)
            .agg(F.sort_array(F.collect_list(F.struct("at", "reach_left", "reach_right"))).alias("spans")))


def removed_runs(size: int, spans: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes to remove."""
    w, _ = shape(length)
    ranges = []
    for s in spans or ():
        left, right = s["reach_left"], s["reach_right"]
        if left < 0:
            left, right = min(s["at"], w - 1), min(size - s["at"], length)
        ranges.append((s["at"] - left, s["at"] + right))
    runs: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    return runs


def remaining(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in runs:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def with_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                 group_rows: int = GROUP_ROWS) -> tuple[DataFrame, str]:
    """``df`` with one column for ``removal``, and that column's name.  Null texts count as empty; repeated rows
    are each judged against the others."""
    found = written(repeats(df, doc_id, text, length, group_rows), "repeats")
    names = [fresh(df, c) for c in ("repeat_doc", "repeat_none", "repeat_body")]
    spans = fresh(df, "repeat_spans")
    for old, new in zip([*_ID, "spans"], [*names, spans]):
        found = found.withColumnRenamed(old, new)
    out = _keyed(df, doc_id, text, names).join(found, names, "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], spans), spans


def _digests(length: int):
    def batch(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for t, s in zip(utf8(texts), spans.to_pylist()):
            t = t or b""
            runs = removed_runs(len(t), s, length)
            rows.append((len(t), sum(b - a for a, b in runs), len(runs), sha256_hex(remaining(t, runs))))
        columns = list(zip(*rows)) or [()] * 4
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          ["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return on_arrow(batch, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _kept(length: int):
    def batch(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([None if t is None else remaining(t, removed_runs(len(t), s, length))
                         for t, s in zip(utf8(texts), spans.to_pylist())], pa.binary())

    return on_arrow(batch, "binary")


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` with the remaining bytes in place of the text; a run may end inside a character, so they are binary."""
    out, spans = with_repeats(df, doc_id, text, length)
    return out.select(*[_kept(length)(F.col(f"`{c}`"), F.col(spans)).alias(c) if c == text else F.col(f"`{c}`")
                        for c in df.columns])


def suffix_query(spark, folder: str) -> DataFrame:
    out, spans = with_repeats(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", _digests(LENGTH)(F.col("text"), F.col(spans)).alias("d")).select("doc_id", "d.*")
