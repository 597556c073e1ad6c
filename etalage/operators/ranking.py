"""Global ranks and tiles without moving all rows into one task.

A window ordered over the whole table runs in a single task.  Tables of any size are instead range-partitioned
on (value, unique key) -- the key splits values that many rows share -- and numbered inside each partition;
the partitions' row counts then give every partition its offset.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from etalage.functions.numbers import edges_passed, percent_of
from etalage.storage import materialise

# monotonically_increasing_id keeps the partition in the upper bits and the row in the lower 33.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rang", written: bool = False) -> DataFrame:
    """Add the position (from 1) of every row under ``order``, which must be total.

    The table is written first, unless ``written`` says that it already is: it is read to find the
    range bounds and again to be partitioned by them.
    """
    stored = df if written else materialise(df, "unordered")
    placed = (stored.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("__mid", F.monotonically_increasing_id()))
    placed = materialise(placed, "ordered")
    partition = F.shiftright("__mid", _ROW_BITS)
    counts = placed.groupBy(partition.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per range partition, so this window and the broadcast are bounded by their number
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return (placed.withColumn("__part", partition)
                  .join(F.broadcast(offsets), "__part")
                  .withColumn(name, F.col("__offset")
                              + F.col("__mid").bitwiseAND(F.lit(_ROW_MASK)) + F.lit(1))
                  .drop("__part", "__mid", "__offset"))


def running_counts(df: DataFrame, value: Column, order: Callable[[Column], Column], name: str = "value") -> DataFrame:
    """(value, n, before): every distinct value, how many rows have it, and how many have a value before it.

    Equal values are counted first, so that no value is hot afterwards; the values alone are range-partitioned
    and added up inside each partition, and the partitions' totals give every partition its offset.
    """
    counts = materialise(df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n")), "values")
    part = F.shiftright(F.monotonically_increasing_id(), _ROW_BITS)
    placed = materialise(counts.repartitionByRange(order(F.col(name))).withColumn("__part", part), "ranges")
    totals = placed.groupBy("__part").agg(F.sum("n").alias("__n"))
    # one row per range partition, so this window and the broadcast are bounded by their number
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__part").orderBy(order(F.col(name))).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("__offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return placed.join(F.broadcast(offsets), "__part").select(name, "n", before.alias("before"))


def global_rank(df: DataFrame, value: str, key: str, name: str = "rang", ascending: bool = False,
                written: bool = False) -> DataFrame:
    """Add the minimum rank of ``value``: equal values share the position of the first of them, nulls come last.

    ``key`` names the rows; equal values need no order among themselves, so the result does not depend on it.
    """
    return global_ranks(df if written else materialise(df, "unranked"), {name: value}, ascending)


def global_ranks(written: DataFrame, ranks: Mapping[str, str], ascending: bool = False) -> DataFrame:
    """Add minimum ranks to a written table: {new name: value}.

    Only the distinct values are sorted; rows join their value's rank where they are.  In that join only the left
    side can hold a hot value, and that is the side which adaptive execution splits.
    """
    direction = F.asc_nulls_last if ascending else F.desc_nulls_last
    out = written
    for name, value in ranks.items():
        places = running_counts(written.select(value), F.col(value), direction, "__value")
        first = places.select("__value", (F.col("before") + 1).alias(name))
        out = out.join(first, F.col(value).eqNullSafe(F.col("__value")), "left").drop("__value")
    return out


def ntile_edges(df: DataFrame, tiles: int, value: str, key: str, written: bool = False) -> DataFrame:
    """One row, one column ``edges``: the (value, key) pairs that open tiles 2..n in ascending order.

    Tiles differ by at most one row, the larger ones first, as NTILE makes them.
    """
    numbered = global_row_number(df.select(F.col(value).alias("v"), F.col(key).alias("k")),
                                 [F.asc_nulls_first("v"), F.asc_nulls_first("k")], "__row", written)
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    size, larger = F.floor(total / tiles), total % tiles
    starts = [size * t + F.least(larger, F.lit(t)) + 1 for t in range(1, tiles)]
    # with fewer rows than tiles the later tiles have no opening row and stay empty
    opening = numbered.where(F.col("__row").isin(*starts))
    pairs = F.sort_array(F.collect_list(F.struct("v", "k")))
    return opening.agg(pairs.alias("edges"))


def ntile_of(value: Column, key: Column, edges: Column, tiles: int) -> Column:
    """Tile of a row, given the edges of its table: one plus the edges at or before it."""
    row = F.struct(value.alias("v"), key.alias("k"))
    return F.lit(1) + edges_passed(edges, tiles - 1, lambda edge: edge <= row)


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add ``value`` in percent of its total (two digits); the total is a one-row subquery."""
    total = df.agg(F.sum(value).alias("total")).scalar()
    return df.withColumn(name, percent_of(F.col(value), total))
