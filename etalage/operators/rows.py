"""Row-level building blocks: filters, de-duplication, alignment and key differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from etalage import contracts as K
from etalage.functions.text import is_blank
from etalage.storage import materialise


def missing_id_filter(df: DataFrame, *id_cols: str) -> DataFrame:
    """Keep rows whose identifiers are neither null nor empty."""
    return df.where(_all([~is_blank(F.col(c)) for c in id_cols]))


def amount_range(df: DataFrame, col: str, lo: float = K.AMOUNT_MIN, hi: float = K.AMOUNT_MAX) -> DataFrame:
    """Keep amounts within the inclusive bounds."""
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))


def positive_quantity(df: DataFrame, col: str = "quantite") -> DataFrame:
    return df.where(F.col(col) > 0)


def status_is_not(df: DataFrame, col: str, status: str) -> DataFrame:
    """Drop a status; rows without a status go too, as in SQL."""
    return df.where(F.trim(F.col(col)) != status)


def status_is(df: DataFrame, col: str, status: str) -> DataFrame:
    return df.where(F.trim(F.col(col)) == status)


def accepted_set(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.where(F.col(col).isin(*values))


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``, which must be total so that the choice is fixed.

    Filtering on row number 1 lets Spark cut every map task down to one row per key before the
    shuffle, so a key that holds a third of all rows costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def keep_last(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ascending ``order`` (the arrival order of the rows)."""
    return keep_first(df, keys, [F.desc_nulls_last(c) for c in order])


def dedup_latest(df: DataFrame, keys: Sequence[str], date: str, tiebreak: Sequence[str]) -> DataFrame:
    """One row per key with the latest date; rows without a date come first, as in SQL."""
    return keep_first(df, keys, [F.desc_nulls_first(date), *[F.asc_nulls_first(c) for c in tiebreak]])


def with_distinct_counts(grouped: DataFrame, df: DataFrame, keys: Sequence[str], counts: dict[str, str]) -> DataFrame:
    """Add to a grouped table the distinct values per group of some columns: {new name: column of ``df``}.

    Several distinct counts in one aggregation would multiply every row by their number.  Here each column is a
    narrow aggregation of its own over (keys, column), joined on the keys, null ones included.
    """
    for name, column in counts.items():
        pairs = df.where(F.col(column).isNotNull()).select(*keys, column).distinct()
        counted = pairs.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        grouped = (grouped.join(counted, same, "left").withColumn(name, F.coalesce("__n", F.lit(0).cast("bigint")))
                   .drop("__n", *[f"__{k}" for k in keys]))
    return grouped


def grouped_with_distinct_counts(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], counts: Mapping[str, str]
                                 ) -> DataFrame:
    """Aggregates per group beside the distinct values of some columns: {new name: column of ``df``}.

    Meant for groups about as many as rows, where joining one aggregation per count would sort all of them again:
    the distinct (keys, value) pairs stand as rows of their own under those of ``df``, and one aggregation takes both.
    In their rows all other columns are null, so each aggregate must pass over nulls.
    """
    marked = df
    for name, column in counts.items():
        pairs = df.where(F.col(column).isNotNull()).select(*keys, column).distinct()
        marked = marked.unionByName(pairs.select(*keys, F.lit(1).alias(f"__{name}")), allowMissingColumns=True)
    distinct = [F.coalesce(F.sum(f"__{name}"), F.lit(0).cast("bigint")).alias(name) for name in counts]
    return marked.groupBy(*keys).agg(*[c.alias(name) for name, c in aggregates.items()], *distinct)


def read_often(df: DataFrame, columns: Sequence[str], written: bool = False) -> DataFrame:
    """Those of the columns that ``df`` has, written once for several reads, unless ``df`` is a written table."""
    own = df.select(*[c for c in dict.fromkeys(columns) if c in df.columns])
    return own if written else materialise(own, "read-often")


def column_slimming(df: DataFrame, wanted: Sequence[str], renames: dict[str, str] | None = None) -> DataFrame:
    """Keep those of the wanted columns that exist, renamed where asked."""
    renames = renames or {}
    return df.select(*[F.col(c).alias(renames.get(c, c)) for c in wanted if c in df.columns])


def union_aligned(*frames: DataFrame) -> DataFrame:
    """Concatenate by column name; columns that a frame lacks become null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def key_set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have; a null key counts as absent.

    One aggregation over the keys of both, which map tasks combine first.  An anti join after a distinct would be
    moved below it by the optimizer and sort every row of ``left``.
    """
    both = left.select(key, F.lit(False).alias("__known")).unionByName(right.select(key, F.lit(True).alias("__known")))
    found = both.groupBy(key).agg(F.bool_or("__known").alias("__known"), F.bool_or(~F.col("__known")).alias("__used"))
    return found.where(F.col("__used") & (~F.col("__known") | F.col(key).isNull())).select(key)


def broken_references(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose non-null key has no match in ``parent``."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``nb_total`` and ``nb_doublons`` (rows beyond the first of each key)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("nb_total"),
                   F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("nb_doublons")))


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a whole row."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def duplicate_rows(df: DataFrame, hashes: DataFrame | None = None) -> DataFrame:
    """One row: ``doublons``, the rows beyond the first of each set of identical rows.

    Only a 64-bit hash per row is shuffled; whole rows are compared for repeated hashes alone.  The
    repeated hashes are written, so that Spark knows their size when it plans the second pass and
    leaves the other rows where they are if it can.  ``hashes``: the rows' hashes as a written column ``__h``; ``df`` is
    then read for repeated ones only.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.select(row_hash(df).alias("__h"), F.struct(*columns).alias("__row"))
    repeated = (hashed if hashes is None else hashes).groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__h")
    repeated = materialise(repeated, "repeated")
    return (hashed.join(repeated, "__h", "left_semi")
                  .groupBy("__h", "__row").agg(F.count(F.lit(1)).alias("n"))
                  .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("doublons")))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows in ``order``: each task keeps k rows, no global sort."""
    return df.orderBy(*order).limit(k)


def sort_output(df: DataFrame, *order: Column) -> DataFrame:
    """Total order for a final result (a range shuffle; never needed between operators)."""
    return df.orderBy(*order)


def _all(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result
