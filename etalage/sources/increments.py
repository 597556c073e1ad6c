"""Delta extraction by high-water mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def incremental_extract(source: DataFrame, marks: DataFrame, table: str, updated: str = "date_maj") -> DataFrame:
    """Rows updated after the last extraction; all rows when the table was never extracted.

    ``marks`` has one row per extraction (``table_cible``, ``derniere_extraction``).  The mark is a scalar
    subquery, so the comparison reaches the source's scan as a filter.
    """
    last = marks.where(F.col("table_cible") == table).agg(F.max("derniere_extraction").alias("m")).scalar()
    never = last.isNull()
    return source.where(never | (F.col(updated) > last))


def next_mark(extracted: DataFrame, table: str, updated: str = "date_maj") -> DataFrame:
    """The row to append to ``marks`` after a successful load; none when nothing was extracted."""
    mark = extracted.agg(F.max(updated).alias("derniere_extraction")).where(F.col("derniere_extraction").isNotNull())
    return mark.select(F.lit(table).alias("table_cible"), "derniere_extraction")
