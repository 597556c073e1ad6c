"""Files that arrive between two daily runs, processed once each.

Every query runs with ``availableNow``: it takes what has arrived since its checkpoint, then ends.
Checkpoints and tables belong in storage that all executors share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from etalage import contracts as K
from etalage.sinks.files import CORRUPT, raw_schema, stamp_bronze
from etalage.sinks.warehouse import UPSERT, load_table


def bronze_stream(spark: SparkSession, folder: str, columns: Sequence[str], path: str, checkpoint: str,
                  files_per_batch: int = 1000) -> StreamingQuery:
    """Copy new CSV files to the raw layer, malformed rows to its quarantine partition."""
    raw = (spark.readStream.options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                                    escape='"', maxFilesPerTrigger=files_per_batch)
           .schema(raw_schema(list(columns))).csv(folder))
    stamped = stamp_bronze(raw, F.current_timestamp())
    return (stamped.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .partitionBy("ingest_date", "etat").trigger(availableNow=True).start(path))


def upsert_stream(spark: SparkSession, folder: str, schema: T.StructType, root: str, table: str,
                  keys: Sequence[str], order_by: Sequence[str], checkpoint: str,
                  files_per_batch: int = 1000) -> StreamingQuery:
    """Merge new Parquet files into a warehouse table, the last row per key winning.

    A batch that is repeated after a failure merges the same rows again, which changes nothing.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            load_table(batch, root, table, UPSERT, keys, order_by, run_id=f"batch-{batch_id}")

    arrivals = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return (arrivals.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def daily_volume_table(rows: DataFrame, ts: str, root: str, table: str, checkpoint: str, late: str = "1 day",
                       minimum: int = K.DAILY_ROWS_MIN) -> StreamingQuery:
    """Keep a warehouse table of the rows per day of a stream: every day that has rows, with its latest count."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            load_table(batch, root, table, UPSERT, ["jour"], ["nb_lignes"], run_id=f"batch-{batch_id}", buckets=1)

    return (daily_volume_stream(rows, ts, late, minimum).writeStream.outputMode("update").foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def daily_volume_stream(rows: DataFrame, ts: str, late: str = "1 day", minimum: int = K.DAILY_ROWS_MIN) -> DataFrame:
    """Rows per calendar day of a stream, whatever the session's time zone.

    In append mode a day is put out once no row up to ``late`` behind can still arrive, so the last days stay
    open; in update mode every day is put out as it changes, for a table that keeps the latest count.
    """
    # windows start at midnight UTC, so the rows' own clock is put there
    clock = F.from_utc_timestamp(F.col(ts).cast("timestamp_ntz").cast("timestamp"), F.current_timezone())
    per_day = (rows.withColumn("__ts", clock).withWatermark("__ts", late)
                   .groupBy(F.window("__ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("nb_lignes")))
    day = F.date_from_unix_date(F.floor(F.unix_seconds("w.start") / 86400).cast("int"))
    return per_day.select(day.alias("jour"), "nb_lignes",
                          F.when(F.col("nb_lignes") >= minimum, K.STATUS_OK).otherwise(K.STATUS_ALERT)
                           .alias("statut"))
