"""Removal of word sequences that an earlier document holds, by seed and extend.

A word goes if it lies in a window of ``length`` words that also starts in a document with a smaller id.

1. **Seeds.**  Every window picks its *anchor*, the k words in it with the least hash (the first of equal ones).  Equal
   windows pick the same anchor at the same place, so documents that share a window meet at its anchor.  Consecutive
   windows with one anchor form a block; a document has one row per block, about one in (length - k) / 2 words.
2. **Join.**  Blocks are joined by the anchor's hash.  Anchors that only one document holds are done.
3. **Extend.**  A block reaches from its anchor to both sides as far as its windows do.  Where all of a block's words
   equal those of an earlier document's block, the whole block repeats.  Of the blocks with equal words those of the
   smallest id go on, if the anchor also has other surroundings: their extent to the left and to the right is found
   window by window, by the least id among equal windows.
4. **Maximal repeats.**  What repeats is joined per document into runs that cannot be extended, of ``length`` words
   or more.

Members of a group are never paired.  Each step is an aggregation that combines before it shuffles (least and greatest
id), and a join of thin rows with one row per group, which Spark splits at a hot group.  So a passage that a third of
all documents share costs each of them some rows, whatever the number of copies.  Equality of blocks and windows is
decided by 128-bit hashes; the anchor's 64 bits only bring together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from etalage.llm.common import fresh, on_arrow, sha256_hex, utf8, written

LENGTH = 50
_TOGETHER = 1 << 18  # words of short texts that are hashed together
_ODD, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(31)


def anchor_words(length: int) -> int:
    """Words of an anchor: the longer, the fewer chance meetings, but the more blocks."""
    return max(1, length * 2 // 5)


# Seeds ---------------------------------------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _ODD
    return x ^ (x >> _SHIFT)


def word_hashes(words: list[bytes]) -> np.ndarray:
    codes = pa.array(words, pa.large_binary()).dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in codes.dictionary.to_pylist()], np.uint64)
    return known[codes.indices.to_numpy()]


def _grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k neighbours; the last ones, which are not whole, are missing."""
    out, size, own = None, 0, hashes
    for bit in range(k.bit_length()):
        if bit:
            half = 1 << (bit - 1)
            own = _mixed(own[:len(own) - half] * _ODD + own[half:])
        if k >> bit & 1:
            if out is None:
                out = own
            else:
                out = _mixed(out[:len(own) - size] * _ODD + own[size:])
            size += 1 << bit
    return out


def _first_least(values: np.ndarray, w: int) -> np.ndarray:
    """Place of the first least of every w neighbours."""
    place, least, size = np.arange(len(values)), values, 1
    while size < w:
        step = min(size, w - size)
        right = least[step:] < least[:len(least) - step]
        place = np.where(right, place[step:], place[:len(place) - step])
        least = np.where(right, least[step:], least[:len(least) - step])
        size += step
    return place


def blocks(texts: list[list[bytes]], length: int = LENGTH) -> Iterator[tuple[int, list[tuple[int, int, int, bytes]]]]:
    """For each text with windows its number and its blocks: first window, windows, anchor's hash, words' hash."""
    k = anchor_words(length)
    words = [w for t in texts for w in t]
    if len(words) < length:
        return
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    joined = b" ".join(words)
    place = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
    anchor = _first_least(_grams(word_hashes(words), k), length - k + 1)
    text = np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(np.arange(len(words)) + length <= np.repeat(begin[1:], sizes))
    if not len(at):
        return
    picked, text = anchor[at], text[at]
    new = np.concatenate([[True], (picked[1:] != picked[:-1]) | (text[1:] != text[:-1])])
    first = at[new]
    count = np.diff(np.concatenate([np.flatnonzero(new), [len(at)]]))
    picked, text = picked[new], text[new]
    columns = (first - begin[text], count, place[picked], place[picked + k] - 1, place[first],
               place[first + count - 1 + length] - 1)
    own: list[tuple[int, int, int, bytes]] = []
    for i, (start, n, a, b, c, d) in enumerate(zip(*(x.tolist() for x in columns))):
        own.append((start, n, xxhash.xxh3_64_intdigest(joined[a:b]) - (1 << 63), xxhash.xxh3_128_digest(joined[c:d])))
        if i + 1 == len(text) or text[i + 1] != text[i]:
            yield int(text[i]), own
            own = []


def _halves(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    pairs = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
    return pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))


def _block_rows(length: int):
    def batch(texts: pa.Array) -> pa.Array:
        starts, counts, keys, digests, sizes = [], [], [], [], [0] * len(texts)
        base, held, size = 0, [], 0
        for i, t in enumerate(utf8(texts)):
            held.append((t or b"").split())
            size += len(held[-1])
            if size >= _TOGETHER or i + 1 == len(texts):
                for j, own in blocks(held, length):
                    sizes[base + j] = len(own)
                    for column, values in zip((starts, counts, keys, digests), zip(*own)):
                        column.extend(values)
                base, held, size = i + 1, [], 0
        one, two = _halves(digests)
        rows = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(counts, pa.int32()),
                                           pa.array(keys, pa.int64()), one, two], ["start", "n", "key", "d0", "d1"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), rows)

    return on_arrow(batch, "array<struct<start: int, n: int, key: long, d0: long, d1: long>>")


# Extension -----------------------------------------------------------------------------------------------------------

def _window_rows(length: int):
    def batch(texts: pa.Array, places: pa.Array) -> pa.Array:
        at, digests, ends = [], [], [0]
        for t, own in zip(utf8(texts), places.to_pylist()):
            words = t.split()
            joined = b" ".join(words)
            place = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)]).tolist()
            for p in own:
                for i in range(p["start"], p["start"] + p["n"]):
                    at.append(i)
                    digests.append(xxhash.xxh3_128_digest(joined[place[i]:place[i + length] - 1]))
            ends.append(len(at))
        one, two = _halves(digests)
        rows = pa.StructArray.from_arrays([pa.array(at, pa.int32()), one, two], ["start", "w0", "w1"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return on_arrow(batch, "array<struct<start: int, w0: long, w1: long>>")


def repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc, body, spans): for each document, by id and digest of its text, the windows that an earlier one holds.

    ``spans`` is an array of (start, n): n consecutive windows from word ``start`` on.  Documents without
    repeats are missing.
    """
    slim = df.select(F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("body"),
                     F.col(f"`{text}`").alias("text")).where(F.col("doc").isNotNull() & F.col("text").isNotNull())
    listed = written(slim.select("doc", "body", F.explode(_block_rows(length)(F.col("text"))).alias("b"))
                     .select("doc", "body", "b.*"), "blocks", compression="zstd")
    shared = written(listed.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
                     .where("least < most").select("key"), "shared-anchors")
    met = written(listed.join(shared, "key"), "met-blocks", compression="zstd")

    same = ["key", "d0", "d1"]
    kinds = written(met.groupBy(*same).agg(F.min("doc").alias("least"), F.max("doc").alias("most")), "surroundings")
    # Written, so that the join reads both sides as they are and is split where an anchor has very many surroundings.
    mixed = written(kinds.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1")
                    .select("key", F.lit(True).alias("mixed")), "mixed-anchors")
    wanted = kinds.join(mixed, "key", "left").where("least < most or mixed").select(*same, "least", "mixed")
    judged = written(met.join(wanted, same), "judged-blocks", compression="zstd")
    whole = judged.where("doc > least").select("doc", "body", "start", "n")

    places = written(judged.where("mixed and doc = least").groupBy("doc", "body")
                     .agg(F.collect_set(F.struct("start", "n")).alias("places")), "open-blocks")
    windows = written(slim.join(places, ["doc", "body"])
                      .select("doc", "body", F.explode(_window_rows(length)(F.col("text"), F.col("places"))).alias("w"))
                      .select("doc", "body", "w.*"), "windows", compression="zstd")
    again = written(windows.groupBy("w0", "w1").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
                    .where("least < most").select("w0", "w1", "least"), "repeated-windows")
    single = (windows.join(again, ["w0", "w1"]).where("doc > least")
              .select("doc", "body", "start", F.lit(1).alias("n")))
    return whole.unionByName(single).groupBy("doc", "body").agg(F.collect_set(F.struct("start", "n")).alias("spans"))


# Maximal repeats -----------------------------------------------------------------------------------------------------

def maximal(spans: list[dict] | None, length: int = LENGTH) -> list[tuple[int, int]]:
    """The runs of words to remove, as (start, end): none can be extended, each has ``length`` words or more."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["start"] + s["n"] - 1 + length) for s in spans or ()):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    return runs


def _kept(words: list[bytes], spans: list[dict] | None, length: int) -> list[bytes]:
    kept, at = [], 0
    for a, b in maximal(spans, length):
        kept += words[at:a]
        at = b
    return kept + words[at:]


def with_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> tuple[DataFrame, str]:
    """``df`` with a column of the repeated windows (null: none), and that column's name.

    Words are what stands between ASCII white space.  A null text has none.  A document without an id is
    neither earlier nor later than another: it keeps all, and nothing is removed for its sake.  Rows of one id
    are not earlier than each other, whether their texts are equal or not.  Ids are compared in their own order.
    """
    doc, body, spans = (fresh(df, c) for c in ("repeat_doc", "repeat_body", "repeat_spans"))
    found = written(repeats(df, doc_id, text, length), "repeats")
    found = found.select(F.col("doc").alias(doc), F.col("body").alias(body), F.col("spans").alias(spans))
    same = (F.col(f"`{doc_id}`") == F.col(doc)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(body))
    return df.join(found, same, "left").drop(doc, body), spans


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` with repeats cut out of the texts; the kept words of such a text are joined by single blanks.

    Other texts stay as they are.  A document that loses all its words stays, with an empty text.
    """
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([t if not s or t is None else b" ".join(_kept(t.split(), s, length))
                         for t, s in zip(utf8(texts), spans.to_pylist())], pa.binary()).cast(pa.string())

    out, spans = with_repeats(df, doc_id, text, length)
    return out.select(*[on_arrow(cut, "string")(F.col(f"`{c}`"), F.col(spans)).alias(c) if c == text
                        else F.col(f"`{c}`") for c in df.columns])


def maximal_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc, body, start, end): one row per maximal repeat, in words of its document."""
    def joined(spans: pa.Array) -> pa.Array:
        run = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.array([[{"start": a, "end": b} for a, b in maximal(s, length)] for s in spans.to_pylist()], run)

    found = repeats(df, doc_id, text, length)
    runs: Column = on_arrow(joined, "array<struct<start: int, end: int>>")(F.col("spans"))
    return found.select("doc", "body", F.explode(runs).alias("r")).select("doc", "body", "r.*")


def _digests(length: int):
    def batch(texts: pa.Array, spans: pa.Array) -> pa.Array:
        total, removed, sha = [], [], []
        for t, s in zip(utf8(texts), spans.to_pylist()):
            words = (t or b"").split()
            kept = _kept(words, s, length)
            total.append(len(words))
            removed.append(len(words) - len(kept))
            sha.append(sha256_hex(b" ".join(kept)))
        return pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                                          ["n_words", "n_removed", "kept_sha256"])

    return on_arrow(batch, "n_words long, n_removed long, kept_sha256 string")


def substring_query(spark, folder: str) -> DataFrame:
    out, spans = with_repeats(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", _digests(LENGTH)(F.col("text"), F.col(spans)).alias("d")).select("doc_id", "d.*")
