"""Line de-duplication across documents: lines whose key occurs in many documents go."""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from etalage.llm.common import fresh, on_arrow, per_text, sha256_hex, utf8, written

MIN_CHARS = 1
MIN_DOCS = 10


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z in lower case (both ASCII only)."""
    return line.strip().lower()


def _keys(min_chars: int):
    def keys(text: bytes) -> tuple[list[dict]]:
        """The distinct 128-bit keys of a text, and for each the positions of its lines."""
        at: dict[bytes, list[int]] = {}
        for i, line in enumerate(text.split(b"\n")):
            key = line_key(line)
            if len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars):
                at.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
        return ([{"key": k, "at": v} for k, v in at.items()],)

    line = pa.struct([("key", pa.binary()), ("at", pa.list_(pa.int32()))])
    return per_text(keys, {"lines": pa.list_(line)}, "lines array<struct<key: binary, at: array<int>>>")


def common_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, body, drop): the line positions to drop, by document id and 64-bit digest of the text.

    Lines are exploded and hashed, distinct document ids are counted per hash, and the lines are joined with
    the hashes over the threshold.  Both counts combine before they shuffle, so a line that a third of all
    documents share is summed in parts; its join is one that Spark splits.  Repeated rows count once.
    """
    keyed = df.select(F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("body"),
                      _keys(min_chars)(F.col(f"`{text}`")).alias("keyed"))
    lines = (keyed.select("doc", "body", F.explode("keyed.lines").alias("line"))
             .groupBy("doc", "body", "line.key").agg(F.first("line.at").alias("at")))
    lines = written(lines, "lines")
    counts = lines.select("key", "doc").distinct().groupBy("key").agg(F.count("*").alias("docs"))
    common = written(counts.where(F.col("docs") >= min_docs).select("key"), "common-lines")
    found = lines.join(common, "key").select("doc", "body", "at")
    return found.groupBy("doc", "body").agg(F.flatten(F.collect_list("at")).alias("drop"))


def _keep(text: bytes, drop: list[int] | None) -> tuple[bytes, int]:
    lines = text.split(b"\n")
    if not drop:
        return text, len(lines)
    gone = set(drop)
    return b"\n".join([x for i, x in enumerate(lines) if i not in gone]), len(lines)


def _kept_text(texts: pa.Array, drops: pa.Array) -> pa.Array:
    kept = [None if t is None else _keep(t, d)[0] for t, d in zip(utf8(texts), drops.to_pylist())]
    return pa.array(kept, pa.binary()).cast(pa.string())


def _digest(texts: pa.Array, drops: pa.Array) -> pa.Array:
    rows = []
    for t, d in zip(utf8(texts), drops.to_pylist()):
        kept, n = _keep(t or b"", d)
        rows.append((n, len(d or ()), sha256_hex(kept)))
    n, dropped, sha = zip(*rows) if rows else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(sha, pa.string())],
                                      ["n_lines", "n_dropped", "kept_sha256"])


kept_text = on_arrow(_kept_text, "string")
digest = on_arrow(_digest, "n_lines long, n_dropped long, kept_sha256 string")


def with_drops(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
               min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> tuple[DataFrame, str]:
    """``df`` with one column of the line positions to drop (null: none), and that column's name."""
    drops = written(common_lines(df, doc_id, text, min_docs, min_chars), "line-drops")
    doc, body, drop = (fresh(df, c) for c in ("drop_doc", "drop_body", "drop"))
    drops = drops.select(F.col("doc").alias(doc), F.col("body").alias(body), F.col("drop").alias(drop))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(doc)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(body))
    return df.join(drops, same, "left").drop(doc, body), drop


def drop_common_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``df`` with those lines gone and the others joined in their order.

    A document that loses all its lines stays, with an empty text; a null text stays null; null ids are one
    document.  Lines of fewer than ``min_chars`` characters never go.
    """
    out, drop = with_drops(df, doc_id, text, min_docs, min_chars)
    return out.select(*[kept_text(F.col(f"`{c}`"), F.col(drop)).alias(c) if c == text else F.col(f"`{c}`")
                        for c in df.columns])


def line_dedup_query(spark, folder: str) -> DataFrame:
    out, drop = with_drops(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", digest("text", drop).alias("d")).select("doc_id", "d.*")
