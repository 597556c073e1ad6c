"""Contiguous shards of near equal bytes, from prefix sums over range partitions.

Rows are range-partitioned by a total order and summed within each partition; the totals of the partitions
give each its place in the whole, and the whole is cut at equal targets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from etalage.llm.common import fresh, written

SHARDS = 16


def _running(size_at: int, names: list[str]):
    """Adds the bytes and rows that stand before each row within its partition."""
    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = rows = 0
        for batch in batches:
            own = batch.column(size_at).to_numpy(zero_copy_only=False)
            upto = np.cumsum(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(upto - own + size), pa.array(np.arange(rows, rows + len(own)))],
                names=names)
            size, rows = size + int(upto[-1]) if len(own) else size, rows + len(own)

    return running


def assign_shards(df: DataFrame, size: str, order: list[str], shards: int = SHARDS,
                  partitions: int | None = None) -> DataFrame:
    """``df`` with columns ``shard`` and ``slot`` (its place in the shard, from 0).

    ``size`` names a column of whole numbers above 0; ``order`` the columns that define the order (nulls
    first).  Rows equal in all of them keep the order in which they were written, so they too can be
    dealt over several partitions.  A row lies in the shard that holds its middle byte: each cut is at most
    half a row from its target.  Only one total per partition is summed in one place.
    """
    spark = df.sparkSession
    tie, part, before, row = (fresh(df, c) for c in ("shard_tie", "shard_part", "shard_before", "shard_row"))
    shard, slot = fresh(df, "shard"), fresh(df, "slot")
    numbered = written(df.withColumn(tie, F.monotonically_increasing_id()), "shard-input")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(f"`{c}`") for c in order], F.col(tie)]
    ranged = numbered.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(part, F.spark_partition_id())
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    names = [*ranged.columns, before, row]
    summed = written(ranged.mapInArrow(_running(names.index(size), names), f"{types}, `{before}` long, `{row}` long"),
                     "shard-sums")
    totals = summed.groupBy(part).agg(F.sum(F.col(f"`{size}`")).alias("bytes"), F.count("*").alias("rows"))
    # One row per partition: their number is set, not given by the data.
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(totals.select(
        part, F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("at_byte"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("at_row"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes")), "shard-offsets")
    placed = summed.join(F.broadcast(offsets), part)
    placed = placed.withColumn(shard, F.expr(f"({shards} * (2 * (`{before}` + at_byte) + `{size}`)) div (2 * all_bytes)")
                               .cast("int")).withColumn(row, F.col(row) + F.col("at_row"))
    firsts = written(placed.groupBy(shard).agg(F.min(row).alias("first_row")), "shard-firsts")
    out = placed.join(F.broadcast(firsts), shard).withColumn(slot, F.col(row) - F.col("first_row"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.col(shard), F.col(slot))


def shard_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), by ascending id, then size and checksum.

    The size of a null text is 1, as of an empty one.  Null ids come first.  Repeated rows are placed one
    after the other.  An empty table gives an empty table.
    """
    body = F.coalesce(F.encode(F.col(f"`{text}`"), "UTF-8"), F.lit(b""))
    slim = df.select(F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
                     F.crc32(body).alias("text_crc32"))
    return assign_shards(slim, "size", ["doc_id", "size", "text_crc32"], shards)


def write_shards(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> None:
    """Write whole documents to one folder per shard, in slot order within each file."""
    size = fresh(df, "bytes")
    sized = df.withColumn(size, F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + 1)
    placed = assign_shards(sized, size, [doc_id, size], shards)
    shard, slot = placed.columns[-2:]
    placed.drop(size).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)


def sharding_query(spark, folder: str) -> DataFrame:
    placed = shard_documents(spark.read.parquet(f"{folder}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
