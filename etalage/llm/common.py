"""Small helpers of the training-data operators."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from etalage.storage import scratch_path


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in any spelling."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(values: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes; None for null."""
    return values.cast(pa.large_binary()).to_pylist()


def on_arrow(batch: Callable[..., pa.Array], schema: str) -> Callable[..., Column]:
    """A column function from one that takes and returns Arrow arrays.

    It is declared non-deterministic so that a filter on the result never makes Spark compute it twice;
    the results themselves depend on the inputs alone.
    """
    return lambda *columns: F.arrow_udf(batch, schema).asNondeterministic()(*columns)


def per_text(of_text: Callable[[bytes], tuple], fields: dict[str, pa.DataType], schema: str) -> Callable:
    """A column function from a text to a struct, one Arrow batch at a time; a null text counts as empty.

    """
    def batch(values: pa.Array) -> pa.Array:
        rows = [of_text(t or b"") for t in utf8(values)]
        columns = list(zip(*rows)) or [()] * len(fields)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.values())], list(fields))

    return on_arrow(batch, schema)


def written(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and fixes the result."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_shared(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file in the shared folder, for use in tasks."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
