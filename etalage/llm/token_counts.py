"""Token counts by rank-synchronous merging of byte pairs.

Texts are cut into pre-tokens.  The pre-tokens of a batch that are not known yet lie one after the other in one
ragged array of symbols; in every round each of them merges all occurrences of its lowest-rank pair at once.
What is left of each is its number of tokens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from etalage.llm.common import fresh, on_arrow, utf8

VOCABULARY = "byte_bpe_50k.json"
OVER = 1024
_CACHED = 1_000_000
_CACHED_CHARS = 64
_AT_ONCE = 100_000  # pre-tokens of one text that are held together
_SHIFT = 1 << 20
_NONE = np.int64(1 << 40)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if printable, else one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=2)
def counter(path: str) -> "Counter":
    return Counter(path)


class Counter:
    """Counts tokens with one vocabulary; the counts of short pre-tokens are remembered."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model = whole["model"]
        if model["type"] != "BPE" or whole["normalizer"] or whole["pre_tokenizer"]["type"] != "ByteLevel" \
                or whole["pre_tokenizer"]["add_prefix_space"] or model["ignore_merges"]:
            raise ValueError(f"not a plain byte-level vocabulary: {path}")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in whole["added_tokens"]):
            raise ValueError(f"added tokens that take in their surroundings: {path}")
        vocab = model["vocab"]
        self.bytes = np.array([vocab[c] for c in byte_symbols()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * _SHIFT + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.find = regex.compile(public_tokenizers.PATTERN)
        added = sorted((t["content"] for t in whole["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.known: dict[str, int] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; _NONE where it does not merge."""
        wanted = left * _SHIFT + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE)

    def merge(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        counts = sizes.copy()
        symbols = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        while len(symbols):
            inside = np.empty(len(symbols), bool)
            inside[:-1], inside[-1] = owner[1:] == owner[:-1], False
            rank = np.full(len(symbols), _NONE)
            at = np.flatnonzero(inside)
            rank[at] = self._rank(symbols[at], symbols[at + 1])
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.concatenate([starts, [len(symbols)]]))
            counts[owner[starts]] = lengths
            lowest = np.repeat(lowest, lengths)
            open_ = lowest < _NONE
            pick = _every_other(open_ & (rank == lowest))
            symbols[pick] = self.made[rank[pick]]
            keep = open_
            keep[pick + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def _count_known(self, words: list[str]) -> int:
        return sum(map(self.known.__getitem__, words))

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if new:
            self.known.update(zip(new, self.merge([w.encode("utf-8") for w in new]).tolist()))

    def _parts(self, text: str) -> Iterator[str | None]:
        """The text between added tokens, and None for each of those."""
        at = 0
        for m in self.added.finditer(text) if self.added else ():
            yield text[at:m.start()]
            yield None
            at = m.end()
        yield text[at:]

    def counts(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text."""
        if len(self.known) > _CACHED:
            self.known.clear()
        total, waiting, held = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            for part in self._parts(text.decode("utf-8", "replace")):
                if part is None:
                    total[i] += 1
                    continue
                found = (m.group() for m in self.find.finditer(part)) if len(part) > _AT_ONCE else iter(self.find.findall(part))
                while words := list(islice(found, _AT_ONCE)):
                    waiting.append((i, words))
                    held += len(words)
                    if held > _AT_ONCE:
                        self._settle(waiting, total)
                        waiting, held = [], 0
        self._settle(waiting, total)
        return total

    def _settle(self, waiting: list[tuple[int, list[str]]], total: list[int]) -> None:
        distinct = set().union(*(words for _, words in waiting))
        long = {w for w in distinct if len(w) > _CACHED_CHARS}
        self._learn(distinct)
        for i, words in waiting:
            total[i] += self._count_known(words)
        for w in long:  # rare, and they would fill the memory
            self.known.pop(w, None)


def _every_other(flags: np.ndarray) -> np.ndarray:
    """Positions of the set flags, without those that follow a position taken: pairs must not overlap."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at
    first = np.concatenate([[True], np.diff(at) > 1])
    run = np.cumsum(first) - 1
    return at[(at - at[first][run]) % 2 == 0]


def _counted(path: str):
    def count(texts: pa.Array) -> pa.Array:
        own = counter(path)
        sizes, tokens = [], []
        for at in range(0, len(texts), 1024):
            part = [t or b"" for t in utf8(texts.slice(at, 1024))]
            sizes += map(len, part)
            tokens += own.counts(part)
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                                          ["n_bytes", "n_tokens"])

    return on_arrow(count, "n_bytes long, n_tokens long")


def with_counts(df: DataFrame, text: str = "text", vocabulary: str | None = None) -> tuple[DataFrame, str]:
    """``df`` with one struct column (n_bytes, n_tokens), and that column's name.

    A null text counts as empty: no bytes, no tokens.  A string of an added token in a text is one token.
    Texts are counted whole and in parts of bounded size; rows are neither moved nor compared.
    """
    import public_tokenizers

    name = fresh(df, "tokens")
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return df.withColumn(name, _counted(path)(F.col(f"`{text}`"))), name


def token_query(spark, folder: str) -> DataFrame:
    out, name = with_counts(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", f"{name}.n_bytes", f"{name}.n_tokens", (F.col(f"{name}.n_tokens") > OVER).alias("over_limit"))
