"""Exact quantiles of any number of rows, quantile bins and outlier bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from etalage import contracts as K
from etalage.functions.numbers import edges_passed
from etalage.storage import materialise

_ROW_BITS = 33


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """One row, one column ``q``: linearly interpolated quantiles as an array of doubles.

    The built-in exact percentile merges every distinct value into one buffer.  Here equal values are
    counted first, written and range-partitioned, and only the partitions that hold a wanted position are
    searched.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "counts")
    part = F.shiftright(F.monotonically_increasing_id(), _ROW_BITS)
    placed = materialise(counts.repartitionByRange("v").withColumn("part", part), "ranges")

    # one row per range partition: the windows below are bounded by the number of partitions
    whole = Window.orderBy("part")
    parts = placed.groupBy("part").agg(F.sum("n").alias("size"))
    parts = parts.select("part", (F.sum("size").over(whole) - F.col("size")).alias("start"),
                         F.sum("size").over(whole).alias("stop"),
                         F.sum("size").over(Window.partitionBy()).alias("total"))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    wanted = (parts.withColumn("w", F.explode(wanted))
                   .withColumn("pos", F.col("w.p") * (F.col("total") - 1))
                   .select("part", "start", "stop", F.col("w.i").alias("i"), "pos",
                           F.floor("pos").alias("lo"), F.ceil("pos").alias("hi")))
    wanted = wanted.where(((F.col("lo") >= F.col("start")) & (F.col("lo") < F.col("stop")))
                          | ((F.col("hi") >= F.col("start")) & (F.col("hi") < F.col("stop"))))

    # at most two partitions per quantile remain
    running = F.col("start") + F.sum("n").over(Window.partitionBy("part", "i").orderBy("v"))
    searched = placed.join(F.broadcast(wanted), "part").withColumn("until", running)

    def at(position: str) -> Column:
        held = (F.col(position) >= F.col("until") - F.col("n")) & (F.col(position) < F.col("until"))
        return F.max(F.when(held, F.col("v").cast("double")))

    found = searched.groupBy("i", "pos", "lo").agg(at("lo").alias("a"), at("hi").alias("b"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - F.col("lo"))
    ordered = F.sort_array(F.collect_list(F.struct("i", value.alias("x"))))
    return found.agg(F.transform(ordered, lambda pair: pair["x"]).alias("q"))


def approx_quantiles(df: DataFrame, col: str, probs: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """Like ``exact_quantiles`` from a mergeable sketch: one pass, observed values, bounded error."""
    return df.agg(F.transform(F.percentile_approx(col, list(probs), accuracy),
                              lambda x: x.cast("double")).alias("q"))


def quantiles(df: DataFrame, col: str, probs: Sequence[float], exact: bool = True) -> DataFrame:
    return exact_quantiles(df, col, probs) if exact else approx_quantiles(df, col, probs)


def quantile_score(value: Column, edges: Column, bins: int, rising: bool) -> Column:
    """Score 1..bins of a value among its quantile edges; 3 for a missing value.

    Bins are closed on the right: the bin of a value is the number of edges strictly below it.
    """
    below = edges_passed(edges, bins - 1, lambda edge: edge < value.cast("double"))
    return F.when(value.isNotNull(), below + 1 if rising else bins - below).otherwise(F.lit(3))


def fixed_bins(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edge, next]``; the last one is open above, null outside all of them."""
    uppers = [*edges[1:], None]
    chain = None
    for lower, upper, label in zip(edges, uppers, labels):
        inside = value > lower if upper is None else (value > lower) & (value <= upper)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


def iqr_bounds(df: DataFrame, col: str, k: float = K.IQR_FACTOR, exact: bool = True) -> DataFrame:
    """One row: ``q1``, ``q3`` and the bounds ``lo`` and ``hi`` beyond which a value is an outlier."""
    q = quantiles(df, col, [0.25, 0.75], exact)
    q = q.select(F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("q3"))
    spread = F.col("q3") - F.col("q1")
    return q.select("q1", "q3", (F.col("q1") - F.lit(k) * spread).alias("lo"),
                    (F.col("q3") + F.lit(k) * spread).alias("hi"))


def iqr_outliers(df: DataFrame, col: str = "montant_total_xaf", k: float = K.IQR_FACTOR,
                 exact: bool = True, of: DataFrame | None = None) -> DataFrame:
    """Add ``est_outlier``; rows are marked, never dropped.  The bounds are those of ``of``, or else of ``df`` itself."""
    bounds = iqr_bounds(df if of is None else of, col, k, exact).select(F.struct("lo", "hi").alias("b")).scalar()
    value = F.col(col).cast("double")
    outside = (value < bounds["lo"]) | (value > bounds["hi"])
    return df.withColumn("est_outlier", F.coalesce(outside, F.lit(False)))
