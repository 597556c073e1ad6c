"""Periodic runs of words, by catching squares with blocks of power-of-two sizes.

Words are appended one after the other.  Whenever a multiple of 2^k words is complete, its last 2^k words become a
*catcher*.  While further words are appended, the catcher compares the last 2^k words of the text with its own; a
match at distance q is the seed of squares of period q.  Each catcher has the range of distances for which a wanted run
must hold a whole aligned block and its copy, so every text position is compared once per level.  From a seed the
comparison of words at distance q goes on to both sides; the stretch of equal words [a, b) holds the squares that
start in it, and all of them merge into one run [a, b + q).

The appends of one level are compared in one vector operation, and many texts pass it together: each ends with a
separator that occurs once, which no square can hold.  Blocks are compared by 64-bit hashes, and every run that is
reported has been compared word by word.  The work is n log n in words, for constant texts too: a seed in a known run
of smaller period only finds that run again and is passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from etalage.llm.common import fresh, on_arrow, utf8

MIN_LENGTH = 24
EXPONENT = 3
_TOGETHER = 1 << 18  # words of short texts that pass the levels together
_CELLS = 1 << 22
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _MIX[2])) * _MIX[1]
    return x ^ (x >> _MIX[2])


def stretch(period: int, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> int:
    """How many words of the shortest wanted run equal the word a period later."""
    return max(min_length - period, (exponent - 1) * period)


def _levels(longest: int, min_length: int, exponent: int) -> Iterator[tuple[int, int, int]]:
    """(block size, first and last period): a stretch of two blocks less one word holds an aligned block."""
    size, first = 0, 1
    for q in range(1, longest // exponent + 2):
        own = 1 << ((stretch(q, min_length, exponent) + 1) // 2).bit_length() - 1
        if own != size or q > longest // exponent:
            if size:
                yield size, first, q - 1
            size, first = own, q


class Runs:
    """The runs of several texts of word numbers, laid end to end."""

    def __init__(self, texts: list[np.ndarray], min_length: int = MIN_LENGTH, exponent: int = EXPONENT):
        if exponent < 2:
            raise ValueError("a run holds a square: the least exponent is 2")
        self.min_length, self.exponent = min_length, exponent
        lengths = np.array([len(t) for t in texts], np.int64)
        longest = int(lengths.max(initial=0))
        alone = np.int64(1 + max((int(t.max(initial=0)) for t in texts), default=0))
        # A separator before the first text and after each.
        parts = [np.array([alone])]
        for i, t in enumerate(texts):
            parts += [t.astype(np.int64), np.array([alone + 1 + i])]
        self.words = np.concatenate(parts)
        self.starts = 1 + np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        self.lengths, self.longest = lengths, longest
        self.found: dict[tuple[int, int], int] = {}  # (start, end) to smallest period

    def of_texts(self) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, length, period), by start and period."""
        self._catch()
        out: list[list[tuple[int, int, int]]] = [[] for _ in self.starts]
        for (a, b), q in self.found.items():
            i = int(np.searchsorted(self.starts, a, side="right")) - 1
            out[i].append((a - int(self.starts[i]), b - a, q))
        return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]

    def _catch(self) -> None:
        """All levels, from small blocks to large; texts too short for a level's periods leave it."""
        origin, words, lengths = np.arange(len(self.words)), self.words, self.lengths
        hashes, size = _mixed(words.astype(np.uint64) + _MIX[0]), 1
        for s, first, last in _levels(self.longest, self.min_length, self.exponent):
            needed = max(self.min_length, self.exponent * first)
            if (lengths < needed).any():
                stays = np.repeat(lengths >= needed, lengths + 1)
                stays = np.concatenate([[True], stays])
                origin, words, hashes = origin[stays], words[stays], hashes[stays]
                lengths = lengths[lengths >= needed]
            if not len(lengths):
                return
            if s < size:  # hashes of smaller blocks anew
                hashes, size = _mixed(words.astype(np.uint64) + _MIX[0]), 1
            while size < s:
                later = np.concatenate([hashes[size:], np.arange(size, dtype=np.uint64)])
                hashes, size = _mixed(hashes * _MIX[0] + later), 2 * size
            self._level(origin, words, hashes, s, first, min(last, int(lengths.max()) // self.exponent))

    def _level(self, origin: np.ndarray, words: np.ndarray, hashes: np.ndarray, s: int, first: int, last: int) -> None:
        blocks = -(-len(words) // s)
        fill = blocks * s + last + s - len(words)
        own = np.concatenate([hashes, _mixed(np.arange(fill, dtype=np.uint64) ^ ~_MIX[0])])
        for r in range(0, blocks, max(1, _CELLS // (last - first + 1))):
            part = own[r * s:]
            n = min(blocks - r, max(1, _CELLS // (last - first + 1)))
            appended = np.lib.stride_tricks.as_strided(part[first:], (n, last - first + 1), (8 * s, 8))
            block, q = np.nonzero(appended == part[:n * s:s, None])
            at, q = (block + r) * s, q + first
            whole = at + q + s <= len(words)
            if whole.any():
                self._seeds(origin, words, s, at[whole], q[whole])

    def _seeds(self, origin: np.ndarray, words: np.ndarray, s: int, at: np.ndarray, q: np.ndarray) -> None:
        """Extend seeds: blocks at ``at`` whose copy is ``q`` words later."""
        known = np.array([run for run, p in self.found.items() if p <= s], np.int64)
        if len(known):  # one of them that holds a seed whole has a period that divides q
            reach = np.zeros(len(self.words) + 1, np.int64)
            np.maximum.at(reach, known[:, 0], known[:, 1])
            new = np.maximum.accumulate(reach)[origin[at]] < origin[at] + q + s
            at, q = at[new], q[new]
            if not len(at):
                return
        turn = np.lexsort((at, q))
        at, q = at[turn], q[turn]
        begins = np.concatenate([[True], (q[1:] != q[:-1]) | (at[1:] != at[:-1] + s)])
        low, q = at[begins], q[begins]
        high = at[np.concatenate([begins[1:], [True]])] + s
        low = low - self._equal(words, low - 1, q, s, -1)
        high = high + self._equal(words, high, q, s, 1)
        wide = np.flatnonzero(high - low >= [stretch(int(p), self.min_length, self.exponent) for p in q])
        for a, b, p in zip(low[wide].tolist(), high[wide].tolist(), q[wide].tolist()):
            same = np.concatenate([[False], words[a:b] == words[a + p:b + p], [False]])
            for c, d in np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2).tolist():
                if d - c >= stretch(p, self.min_length, self.exponent):
                    begin = int(origin[a + c])
                    run = (begin, begin + d - c + p)
                    self.found[run] = min(p, self.found.get(run, p))

    def _equal(self, words: np.ndarray, at: np.ndarray, q: np.ndarray, s: int, step: int) -> np.ndarray:
        """How many words from ``at`` on, in the direction of ``step``, equal those ``q`` later; at most s."""
        out, most = np.empty(len(at), np.int64), len(words) - 1
        ahead, rows = np.arange(s) * step, max(1, _CELLS // s)
        for r in range(0, len(at), rows):
            i = np.clip(at[r:r + rows, None] + ahead, 0, most)
            same = words[i] == words[np.minimum(i + q[r:r + rows, None], most)]
            same &= i + q[r:r + rows, None] <= most
            out[r:r + rows] = np.where(same.all(1), s, same.argmin(1))
        return out


def word_numbers(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Equal numbers for equal words."""
    codes = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode().indices.to_numpy()
    return np.split(codes, np.cumsum([len(t) for t in texts])[:-1]) if texts else []


def _together(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    """Words of consecutive texts, about ``_TOGETHER`` at a time."""
    held, size = [], 0
    for t in texts:
        words = (t or b"").split()
        held.append(words)
        size += len(words)
        if size >= _TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def once(words: list[bytes], own: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    kept, at = [], 0
    for a, b in sorted((start + q, start + n) for start, n, q in own):
        kept += words[at:a]
        at = max(at, b)
    return kept + words[at:]


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def runs(text: Column, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> Column:
    """A struct of a text's ``runs``, an array of (start, length, period) by start and period, and its ``kept`` text.

    Words are what stands between ASCII white space, and places are counted in words.  A run is a stretch of at
    least ``min_length`` words and ``exponent`` times its smallest period that no neighbouring word extends.  The
    kept text has the words that no run holds after its first period, joined by single blanks.  A null text has
    no runs and keeps an empty text, as an empty one does.
    """
    def batch(texts: pa.Array) -> pa.Array:
        found, kept = [], []
        for words in _together(utf8(texts)):
            for w, own in zip(words, Runs(word_numbers(words), min_length, exponent).of_texts()):
                found.append([{"start": a, "length": n, "period": q} for a, n, q in own])
                kept.append(b" ".join(once(w, own) if own else w))
        return pa.StructArray.from_arrays([pa.array(found, _RUN), pa.array(kept, pa.binary()).cast(pa.string())], ["runs", "kept"])

    return on_arrow(batch, "runs array<struct<start: long, length: long, period: long>>, kept string")(text)


def collapse_runs(df: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """``df`` with every run cut to its first period; texts with runs have their words joined by single blanks.

    Other texts, null ones among them, and all other columns stay as they are.  Each text is judged alone, so nothing
    is shuffled, and repeated rows give equal results.
    """
    own, found = F.col(f"`{text}`"), fresh(df, "found_runs")
    out = df.withColumn(found, runs(own, min_length, exponent))
    return out.select(*[F.when(F.size(F.col(found)["runs"]) > 0, F.col(found)["kept"]).otherwise(own).alias(c) if c == text
                        else F.col(f"`{c}`") for c in df.columns])


def longest_first(found: Column) -> Column:
    """Of a text's runs the one with the greatest length by period; the first of equals, by start and period."""
    return F.reduce(found, F.lit(None).cast("struct<start: long, length: long, period: long>"),
                    lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x)
                    .otherwise(best))


def _periodic(ids: pa.Array, texts: pa.Array, checks: pa.Array) -> pa.Array:
    """The contract's texts: of one document in ten the words from some place on repeat with some period."""
    out = []
    for i, t, h in zip(ids.to_pylist(), utf8(texts), checks.to_pylist()):
        if i is not None and t is not None and h % 10 == 0 and (words := t.split()):
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            t = b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)])
        out.append(t)
    return pa.array(out, pa.binary()).cast(pa.string())


periodic = on_arrow(_periodic, "string")


def word_runs_query(spark, folder: str) -> DataFrame:
    """A document without an id keeps its text as it is."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    check = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    found = docs.select("doc_id", runs(periodic("doc_id", "text", check)).alias("found"))
    own = found.select("doc_id", "found.runs", "found.kept", longest_first(F.col("found.runs")).alias("best"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return own.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                      F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                      F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))
