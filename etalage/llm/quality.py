"""Quality rules with adaptive thresholds: mergeable quantile sketches per language and source.

A sketch is a histogram whose buckets have a fixed relative width (ten significant bits), so sketches of
any parts of a corpus merge by adding counts, in any order and with the same result.  The thresholds of a
(language, source) come from its own sketch, to which that of its language is added with the weight of
``min_docs`` documents, and to that the one of the corpus likewise; so one rule holds for groups of every
size, and the more documents a group has, the more its own decide.  The documents are then joined with the
thresholds and filtered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from etalage.llm.common import fresh, per_text, written

SYMBOLS = b"#*$%&|<>"
# Each metric: numerator and denominator in whole numbers, and the least distance from the median (in
# thousandths) at which a document may be rejected.
METRICS = {
    "word_length": ("word_chars", "n_words", 2000),
    "symbol_share": ("n_symbols", "n_words", 100),
    "dup_line_share": ("n_dup_lines", "n_lines", 500),
    "repeat_share": ("n_repeat_words", "n_words", 450),
}
TWO_SIDED = {"word_length"}
SPREAD = 6
MIN_DOCS = 200
_BITS = 10


def _repeat_words(words: list[bytes]) -> int:
    """Words inside a three-word window that occurs at least twice; overlaps count."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    pairs = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
    windows = np.unique(pairs[:-1] * np.int64(len(ids)) + w[2:], return_inverse=True, return_counts=True)
    again = windows[2][windows[1]] > 1
    hit = np.zeros(len(words), bool)
    for shift in range(3):
        hit[shift:shift + len(again)] |= again
    return int(hit.sum())


def features(text: bytes) -> tuple[int, int, int, int, int, int]:
    """Counts of one text: words, their characters, symbols, repeated lines, repeated words, lines with a word."""
    words = text.split()
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), _repeat_words(words), len(lines)


_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_features = per_text(features, dict.fromkeys(_FIELDS, pa.int64()), ", ".join(f"{f} long" for f in _FIELDS))


def with_features(df: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``df`` with one struct column of counts, and that column's name."""
    name = fresh(df, "features")
    return df.withColumn(name, _features(F.col(f"`{text}`"))), name


def base_failed(f: Column) -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])


def _value(f: Column, metric: str) -> Column:
    """The metric in thousandths, rounded down; 0 where there is nothing to divide by."""
    top, bottom, _ = METRICS[metric]
    return F.when(f[bottom] > 0, F.floor(1000 * f[top] / f[bottom])).otherwise(F.lit(0)).cast("long")


def sketches(df: DataFrame, features_column: str, groups: list[str]) -> DataFrame:
    """One row per group, metric and bucket with its count, over the documents that pass the base rules."""
    f = F.col(f"`{features_column}`")
    values = F.create_map(*[x for m in METRICS for x in (F.lit(m), _value(f, m))])
    rows = df.where(~base_failed(f)).select(
        *[F.col(f"`{g}`").alias(f"g{i}") for i, g in enumerate(groups)], F.explode(values).alias("metric", "v"))
    drop = F.greatest(F.lit(0), F.length(F.bin("v")) - _BITS).cast("int")
    rows = rows.withColumn("drop", drop).withColumn("bucket", F.expr("shiftleft(shiftright(v, drop), drop)"))
    return rows.groupBy(*[f"g{i}" for i in range(len(groups))], "metric", "bucket").agg(F.count("*").alias("n"))


def _blended(sketch: DataFrame, depth: int, min_docs: int) -> DataFrame:
    """(keys, metric, bucket, upto, total): cumulated counts of every full group, merged groups mixed in.

    A merged group counts as ``min_docs`` documents, dealt over its buckets in whole numbers, so each group
    takes in at most that many rows.
    """
    keys = [f"g{i}" for i in range(depth)]
    above = None
    for level in range(depth + 1):
        own = sketch.groupBy(*keys[:level], "metric", "bucket").agg(F.sum("n").alias("n"))
        if above is not None:
            groups = own.select(*keys[:level], "metric").distinct()
            same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys[:level - 1]] + [F.col("metric") == F.col("of_metric")]
            taken = groups.join(above, same).select(*keys[:level], "metric", "bucket", F.col("share").alias("n"))
            own = own.unionByName(taken).groupBy(*keys[:level], "metric", "bucket").agg(F.sum("n").alias("n"))
        group = Window.partitionBy(*keys[:level], "metric")  # a group has a bounded number of buckets
        blend = (own.withColumn("upto", F.sum("n").over(group.orderBy("bucket")))
                 .withColumn("total", F.sum("n").over(group)))
        if level < depth:
            share = F.expr(f"(2L * {min_docs} * upto + total) div (2L * total)"
                           f" - (2L * {min_docs} * (upto - n) + total) div (2L * total)")
            above = written(blend.select(*[F.col(k).alias(f"of_{k}") for k in keys[:level]], F.col("metric").alias("of_metric"),
                                         "bucket", share.alias("share")).where("share > 0"), "merged-sketch")
    return blend


def thresholds(sketch: DataFrame, depth: int, min_docs: int = MIN_DOCS, spread: int = SPREAD) -> DataFrame:
    """Lower and upper limit of every metric for each group; ``min_docs`` is the weight of the group above it.

    With m the median and s the smaller of its distances to the 5 % and 95 % quantiles (the side with
    less junk), the limits are m -/+ max(spread * s, least distance of the metric).
    """
    keys = [f"g{i}" for i in range(depth)]
    group = [*keys, "metric"]
    cumulated = _blended(sketch, depth, min_docs)
    at = {q: F.min(F.when(100 * F.col("upto") >= q * F.col("total"), F.col("bucket"))) for q in (5, 50, 95)}
    quantiles = cumulated.groupBy(*group).agg(at[5].alias("q5"), at[50].alias("q50"), at[95].alias("q95"))
    least = F.coalesce(*[F.when(F.col("metric") == m, F.lit(x[2])) for m, x in METRICS.items()])
    two_sided = F.col("metric").isin(*TWO_SIDED)
    width = F.greatest(least, spread * F.least(F.col("q50") - F.col("q5"), F.col("q95") - F.col("q50")))
    limits = quantiles.select(
        *keys, "metric", (F.col("q50") + width).alias("upper"),
        F.when(two_sided, F.col("q50") - width).otherwise(F.lit(-1)).cast("long").alias("lower"))
    entry = F.struct("lower", "upper")
    return limits.groupBy(*keys).agg(*[F.max(F.when(F.col("metric") == m, entry)).alias(m) for m in METRICS])


def judged(df: DataFrame, groups: tuple[str, ...] = ("lang", "source"), text: str = "text",
           min_docs: int = MIN_DOCS, spread: int = SPREAD) -> tuple[DataFrame, str]:
    """``df`` with one struct column: the counts, ``base_failed`` and ``kept``; and that column's name.

    Every group with a document that passes the base rules has limits, so one join decides.  Null and empty
    texts have no words and fail the base rules.  Null languages and sources are groups of
    their own.  Repeated rows are judged alike.  An empty table gives an empty table.
    """
    keys = list(groups)
    slim, f = with_features(df.select(*[F.col(f"`{k}`").cast("string").alias(k) for k in keys],
                                      F.col(f"`{text}`").alias("text")), "text")
    found = thresholds(written(sketches(slim, f, keys), "sketch"), len(keys), min_docs, spread)
    limit, own = fresh(df, "limits"), [fresh(df, f"limits_g{i}") for i in range(len(keys))]
    resolved = found.select(*[F.col(f"g{i}").alias(c) for i, c in enumerate(own)], F.struct(*METRICS).alias(limit))
    out, f = with_features(df, text)
    same = [F.col(f"`{k}`").cast("string").eqNullSafe(F.col(c)) for k, c in zip(keys, own)]
    out = out.join(written(resolved, "group-limits"), same, "left")
    counts, limits = F.col(f"`{f}`"), F.col(limit)
    inside = F.lit(True)
    for m in METRICS:
        inside &= F.coalesce(_value(counts, m).between(limits[m]["lower"], limits[m]["upper"]), F.lit(True))
    failed = base_failed(counts)
    name = fresh(df, "quality")
    out = out.withColumn(name, F.struct(counts.alias("counts"), failed.alias("base_failed"),
                                        (~failed & inside).alias("kept")))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`{name}`")), name


def keep_good(df: DataFrame, groups: tuple[str, ...] = ("lang", "source"), text: str = "text") -> DataFrame:
    """The documents that pass, with the columns of ``df``."""
    out, name = judged(df, groups, text)
    return out.where(F.col(f"`{name}`.kept")).select(*[F.col(f"`{c}`") for c in df.columns])


def quality_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source")
    out, name = judged(docs)
    q = F.col(name)
    return out.select("doc_id", *[q["counts"][c].alias(c) for c in _FIELDS[:5]],
                      q["base_failed"].alias("base_failed"), q["kept"].alias("kept"))
