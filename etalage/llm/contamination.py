"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every word sequence of the items.  Documents stream through it word by word; the length
of the longest suffix that occurs in an item is tracked, and where it reaches a window (13 words, or a whole
shorter item) those words are hit.

Items are dealt to blocks of a bounded number of words, long ones in pieces that overlap by a window less one
word.  Tasks build the automaton of each block and write it to the shared folder.  The documents are scanned once:
each batch passes all blocks, and a task reads them from there one at a time.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from etalage.llm.common import fresh, on_arrow, open_shared, utf8, written
from etalage.llm.sharding import assign_shards
from etalage.storage import scratch_path

WINDOW = 13
BLOCK_WORDS = 200_000
MIN_SHARE = 20  # contaminated from one word in twenty
_WORD_BYTES = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
                    else 32 for c in range(256))


def normalised(text: bytes) -> bytes:
    """A-Z in lower case, every byte outside words a blank; offsets stay."""
    return text.translate(_WORD_BYTES)


class Automaton:
    """Suffix automaton of several word sequences, with the items of every window."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        sequences = [[self.words.setdefault(w, len(self.words)) for w in words] for _, words in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for sequence in sequences:
            last = 0
            for w in sequence:
                last = self._extend(last, w)
        self.least = min([window, *(len(s) for s in sequences)])
        v = len(self.words)
        self.bigrams = np.unique(np.array([a * v + b for s in sequences for a, b in zip(s, s[1:])], np.int64))
        # A window is named by the state and length of its word sequence.
        self.items: dict[tuple[int, int], set] = {}
        for (item, _), sequence in zip(items, sequences):
            size = min(window, len(sequence))
            for state, matched in self._stream(sequence):
                if matched >= size:
                    self.items.setdefault((self._shorten(state, size), size), set()).add(item)
        # For each state the windows that end wherever it does, longest first.
        sizes = sorted({size for _, size in self.items}, reverse=True)
        self.windows: list[tuple[tuple[int, int], ...]] = []
        for state in range(len(self.next)):
            own = []
            for size in sizes:
                if size <= self.length[state]:
                    key = (self._shorten(state, size), size)
                    if key in self.items:
                        own.append(key)
            self.windows.append(tuple(own))

    def _extend(self, last: int, w: int) -> int:
        """Append a word after state ``last``; the state of the longer sequence."""
        known = self.next[last].get(w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, w, known)
        state = self._add({}, self.length[last] + 1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return state

    def _add(self, transitions: dict[int, int], length: int, link: int = 0) -> int:
        self.next.append(transitions)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The shorter sequences of state q become a state of their own."""
        clone = self._add(dict(self.next[q]), self.length[p] + 1, self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _shorten(self, state: int, size: int) -> int:
        """The state of the last ``size`` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _stream(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """State and longest matching length after each word."""
        state = matched = 0
        for w in ids:
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            to = self.next[state].get(w)
            state, matched = (to, matched + 1) if to is not None else (0, 0)
            yield state, matched

    def _stretches(self, words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """Runs of words that may hold a window: each word known and each pair of neighbours in some item."""
        get = self.words.get
        ids = np.fromiter([get(w, -1) for w in words], np.int64, len(words))
        known = ids >= 0
        if int(known.sum()) < self.least:
            return
        pair = known[:-1] & known[1:]
        at = np.flatnonzero(pair)
        keys = ids[at] * len(self.words) + ids[at + 1]
        place = np.searchsorted(self.bigrams, keys)
        pair[at] = (place < len(self.bigrams)) & (self.bigrams[np.minimum(place, len(self.bigrams) - 1)] == keys) \
            if len(self.bigrams) else False
        cuts = np.flatnonzero(~pair) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(ids)]])
        for k in np.flatnonzero(ends - starts >= self.least):
            if known[starts[k]]:
                yield int(starts[k]), ids[starts[k]:ends[k]]

    def hits(self, words: list[bytes], hit: np.ndarray, items: set) -> None:
        """Mark the words that lie in a window, and add the items that the windows belong to."""
        for start, ids in self._stretches(words) if self.items else ():
            for i, (state, matched) in enumerate(self._stream(ids.tolist()), start + 1):
                longest = 0
                for key in self.windows[state]:
                    if key[1] <= matched:
                        longest = max(longest, key[1])
                        items |= self.items[key]
                if longest:
                    hit[i - longest:i] = True


# Blocks --------------------------------------------------------------------------------------------------------------

def _pieces(piece_words: int, window: int):
    """An item as pieces of words; each has the windows that start in its part of the item, whole."""
    def cut(texts: pa.Array) -> pa.Array:
        out = []
        for t in utf8(texts):
            words = normalised(t or b"").split()
            starts = range(0, max(1, len(words) - window + 1) if words else 0, piece_words)
            parts = [words[x:x + piece_words + window - 1] for x in starts]
            out.append([{"piece": i, "words": b" ".join(part), "n": len(part)} for i, part in enumerate(parts)])
        piece = pa.struct([("piece", pa.int64()), ("words", pa.binary()), ("n", pa.int64())])
        return pa.array(out, pa.list_(piece))

    return on_arrow(cut, "array<struct<piece: long, words: binary, n: long>>")


def _build(folder: str, window: int):
    """The automaton of one block as a file of its own; a task that is run again writes another."""
    def build(block: pa.Table) -> pa.Table:
        items = [(item, words.split()) for item, words in zip(block["item"].to_pylist(), block["words"].to_pylist())]
        uri = f"{folder}/{uuid.uuid4().hex}.automaton"
        system, path = open_shared(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        with system.open_output_stream(path, compression=None) as out:
            out.write(zstandard.compress(pickle.dumps(Automaton(items, window), pickle.HIGHEST_PROTOCOL)))
        return pa.table({"uri": pa.array([uri], pa.string())})

    return build


@lru_cache(maxsize=1)
def _automaton(uri: str) -> Automaton:
    """The automaton of a block; a Python worker holds one at a time."""
    system, path = open_shared(uri)
    with system.open_input_stream(path, compression=None) as data:
        return pickle.loads(zstandard.decompress(data.read()))


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS,
           window: int = WINDOW) -> list[str]:
    """Files in the shared folder, one per block, with the automata of about ``block_words`` words each.

    Items are cut into pieces, which running word totals deal to blocks; tasks build and write the automata.  The
    driver has the number of words and the names of the files, and no item or automaton passes it.
    """
    item = F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("None"))
    pieces = written(benchmark.select(item.alias("item"), F.explode(_pieces(block_words, window)(F.col(f"`{text}`"))).alias("p"))
                     .select("item", "p.*"), "benchmark-pieces")
    words = pieces.agg(F.sum("n")).first()[0]
    if not words:
        return []
    dealt = assign_shards(pieces, "n", ["item", "piece"], -(-words // block_words))
    build = _build(scratch_path(benchmark.sparkSession, "automata"), window)
    made = dealt.select("item", "words", "shard").groupBy("shard").applyInArrow(build, "uri string")
    return sorted(r["uri"] for r in written(made, "benchmark-blocks").collect())


# Documents -----------------------------------------------------------------------------------------------------------

def _match(uris: list[str]):
    """A text's matches in all blocks; a batch of texts passes one block after the other."""
    def matched(texts: pa.Array) -> pa.Array:
        texts = utf8(texts)
        hits: list = [None] * len(texts)
        items: list[set[str]] = [set() for _ in texts]
        n = [len(normalised(t or b"").split()) for t in texts]
        for uri in uris:
            block = _automaton(uri)
            for i, t in enumerate(texts):
                if n[i] >= block.least:
                    hits[i] = np.zeros(n[i], bool) if hits[i] is None else hits[i]
                    block.hits(normalised(t).split(), hits[i], items[i])
        spans = [() if h is None else np.flatnonzero(np.diff(np.concatenate([[0], h.astype(np.int8), [0]]))).astype(np.int32)
                 for h in hits]
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.int32())),
             pa.array([sorted(x) for x in items], pa.list_(pa.string()))], ["n_words", "words", "items"])

    return on_arrow(matched, "n_words long, words array<int>, items array<string>")


def matched(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
            window: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, str]:
    """``df`` with one struct column (n_words, words, items), and that column's name.

    ``words`` holds start and end of each run of hit words, in words; ``items`` the ids as sorted strings.
    Null texts have no words; null and repeated items add nothing; without items nothing is hit.  A task holds
    one block at a time, however many there are and however long an item is.
    """
    name = fresh(df, "matches")
    return df.withColumn(name, _match(blocks(benchmark, item_id, item_text, block_words, window))(F.col(f"`{text}`"))), name


def n_hit(m: Column) -> Column:
    """Hit words: the ends of the runs less their starts."""
    return F.aggregate(F.transform(m["words"], lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"),
                       lambda total, x: total + x)


def contaminated(m: Column) -> Column:
    return (n_hit(m) > 0) & (MIN_SHARE * n_hit(m) >= m["n_words"])


def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for t, s in zip(utf8(texts), spans.to_pylist()):
        if t is None or not s:
            out.append(t)
            continue
        clean, kept, at, index = normalised(t), [], 0, 0
        edges = _word_edges(clean)
        for a, b in zip(s[::2], s[1::2]):
            kept.append(t[at:edges[a][0]])
            at = edges[b - 1][1]
        out.append(b"".join(kept) + t[at:])
    return pa.array(out, pa.binary()).cast(pa.string())


def _word_edges(clean: bytes) -> np.ndarray:
    word = np.frombuffer(clean, np.uint8) != 32
    return np.flatnonzero(np.diff(np.concatenate([[0], word.astype(np.int8), [0]]))).reshape(-1, 2)


without_spans = on_arrow(_without, "string")


def drop_contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents under the coverage limit, with the columns and texts of ``df``."""
    out, name = matched(df, benchmark, text)
    return out.where(~contaminated(F.col(f"`{name}`"))).select(*[F.col(f"`{c}`") for c in df.columns])


def cut_spans(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with all hit words, and what stands between them, cut out of the texts."""
    out, name = matched(df, benchmark, text)
    return out.select(*[without_spans(F.col(f"`{c}`"), F.col(f"`{name}`.words")).alias(c) if c == text
                        else F.col(f"`{c}`") for c in df.columns])


def contamination_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    out, name = matched(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    m = F.col(name)
    return out.select("doc_id", m["n_words"].alias("n_words"), n_hit(m).alias("n_hit"),
                      F.size(m["items"]).cast("long").alias("n_items"),
                      F.sha2(F.array_join(m["items"], ","), 256).alias("items_sha256"),
                      contaminated(m).alias("contaminated"))
