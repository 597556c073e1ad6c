"""Packing of token sequences, balanced by attention cost.

Documents become pieces of at most ``CAPACITY`` ids.  In groups of bounded size, the pieces in descending
length each go to the sequence with the least cost so far that has room; the cost of a piece is its length
plus a quadratic term, as attention stays within a document.
"""

from __future__ import annotations

import heapq
import json
import math
import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from etalage.llm.common import on_arrow, utf8, written
from etalage.llm.token_counts import byte_symbols

CAPACITY = 4096
END = 2
QUADRATIC = 24_576  # six times a model width of 4096: a piece of this length costs as much in attention as in the rest
GROUP_PIECES = 4096
VOCABULARY = "word_bpe_49k.json"
_CACHED = 1_000_000
_LONG = 64
_AT_ONCE = 10_000
# Below this no character has a decomposed form and each has a lower-case form of one character.
_PLAIN = re.compile("[\x00-\u012f]*").fullmatch


@lru_cache(maxsize=2)
def encoder(path: str) -> "Encoder":
    return Encoder(path)


class Encoder:
    """Ids of texts from a tokenizer that never joins what white space separates; words are remembered.

    New words of plain letters are cut by the tokenizer's own pattern and go to its merging model at once; all
    others, with characters whose normal form may differ or a special string, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        kinds = [n["type"] for n in whole["normalizer"]["normalizers"]]
        split, bytes_ = whole["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or split["behavior"] != "Removed" \
                or bytes_["type"] != "ByteLevel" or bytes_["add_prefix_space"]:
            raise ValueError(f"not a tokenizer of lower-case words: {path}")
        self.cut = regex.compile(split["pattern"]["Regex"]).findall
        self.merge = self.tokenizer.model.tokenize
        self.symbols = dict(enumerate(byte_symbols()))  # by byte, as Latin-1 has one character for each
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            merged = self.merge(part.encode("utf-8").decode("latin-1").translate(self.symbols))
            ids = array("I", [t.id for t in merged]).tobytes()
            if len(part) <= _LONG:
                self.parts[part] = ids
        return ids

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word."""
        out: list[bytes | None] = []
        odd = []
        for w in words:
            text = w.decode("utf-8", "replace")
            if b"<|" in w or not (text.isascii() or _PLAIN(text)):
                odd.append(w)
                out.append(None)
            else:
                text = text.lower()
                out.append(self._part(text) if text.isalpha() else b"".join(map(self._part, self.cut(text))))
        if odd:
            rest = iter(self.tokenizer.encode_batch([w.decode("utf-8", "replace") for w in odd], add_special_tokens=False))
            out = [array("I", next(rest).ids).tobytes() if ids is None else ids for ids in out]
        return out

    def batch(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers.

        The tokenizer itself puts letters in lower case; doing so first lets fewer words be new.  Texts that may
        hold one of its special strings are left as they are.
        """
        if len(self.known) + len(self.parts) > _CACHED:
            self.known.clear()
            self.parts.clear()
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        get = self.known.get
        found = [list(map(get, words)) for words in split]
        missing = {w for words, ids in zip(split, found) if None in ids for w, i in zip(words, ids) if i is None}
        long: dict[bytes, bytes] = {}
        new = list(missing)
        for at in range(0, len(new), _AT_ONCE):
            part = new[at:at + _AT_ONCE]
            for w, ids in zip(part, self._learn(part)):
                (self.known if len(w) <= _LONG else long)[w] = ids
        out = []
        for words, ids in zip(split, found):
            if None in ids:
                ids = [get(w) if i is None else i for w, i in zip(words, ids)]
                if None in ids:
                    ids = [long[w] if i is None else i for w, i in zip(words, ids)]
            out.append(b"".join(ids))
        return out


def _pieces(path: str, capacity: int):
    end = np.array([END], "<u4").tobytes()

    def pieces(texts: pa.Array) -> pa.Array:
        out = []
        own = encoder(path)
        for at in range(0, len(texts), 256):
            for ids in own.batch([t or b"" for t in utf8(texts.slice(at, 256))]):
                ids += end
                n = len(ids) // 4
                out.append([{"start": s, "length": min(capacity, n - s),
                             "ids_crc32": zlib.crc32(ids[4 * s:4 * (s + capacity)]), "doc_tokens": n}
                            for s in range(0, n, capacity)])
        fields = ["start", "length", "ids_crc32", "doc_tokens"]
        return pa.array(out, pa.list_(pa.struct([(f, pa.int64()) for f in fields])))

    return on_arrow(pieces, "array<struct<start: long, length: long, ids_crc32: long, doc_tokens: long>>")


def pieces(df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document cut every ``capacity`` ids."""
    import public_tokenizers

    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return (df.select(F.col(f"`{doc_id}`").alias("doc_id"), _pieces(path, capacity)(F.col(f"`{text}`")).alias("p"))
            .select("doc_id", F.explode("p").alias("p")).select("doc_id", "p.*"))


def cost(length: int) -> float:
    return length + length * length / QUADRATIC


def assign(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; lengths in descending order.

    There are as many sequences as the ids fill.  A sequence without room for the present piece waits until
    the pieces are short enough; pieces that fit nowhere start the next round of sequences.
    """
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    left, first = list(range(len(lengths))), 0
    sizes = lengths.tolist()
    while left:
        count = max(1, -(-sum(sizes[i] for i in left) // capacity))
        used = [0] * count
        ready = [(0.0, s) for s in range(count)]
        waiting: list[tuple[int, int, float]] = []  # by free room, largest first
        over = []
        for i in left:
            size = sizes[i]
            while waiting and -waiting[0][0] >= size:
                _, s, c = heapq.heappop(waiting)
                heapq.heappush(ready, (c, s))
            while ready and capacity - used[ready[0][1]] < size:
                c, s = heapq.heappop(ready)
                heapq.heappush(waiting, (used[s] - capacity, s, c))
            if not ready:
                over.append(i)
                continue
            c, s = ready[0]
            sequence[i], offset[i] = first + s, used[s]
            used[s] += size
            heapq.heapreplace(ready, (c + cost(size), s))
        left, first = over, first + count
    return sequence, offset


def _pack_group(capacity: int):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("piece", "ascending")])
        sequence, offset = assign(group["length"].to_numpy(), capacity)
        number = group["bin"].to_numpy() * (1 << 32) + sequence
        return (group.drop_columns(["bin", "piece"]).append_column("sequence_id", pa.array(number))
                .append_column("offset", pa.array(offset)))

    return pack


def pack(df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
         capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with their sequence and offset.

    A null text is empty and has the end id only.  Repeated rows are packed each on their own.  Pieces are
    numbered once they are written and dealt by a hash of that number, so every group is a fair sample of
    all lengths and holds about ``group_pieces`` pieces, whatever the ids are.
    """
    cut = written(pieces(df, doc_id, text, vocabulary, capacity).withColumn("piece", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(cut.count() / group_pieces))
    id_type = cut.schema["doc_id"].dataType.simpleString()
    return (cut.withColumn("bin", F.pmod(F.xxhash64("piece"), F.lit(groups)).cast("long")).groupBy("bin")
            .applyInArrow(_pack_group(capacity), f"doc_id {id_type}, start long, length long, ids_crc32 long, "
                          "doc_tokens long, sequence_id long, offset long"))


def packing_query(spark, folder: str) -> DataFrame:
    return pack(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
