"""Small shared helpers: reading a table, whole texts of an Arrow batch, cuts of long plans."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows handled at a time inside a task: bounds memory whatever the size of an Arrow batch.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let every worker import this package, as ``--py-files`` would, wherever the driver was started."""
    if spark.sparkContext.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(), os.path.basename(package))
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
        _SHIPPED.add(spark.sparkContext.applicationId)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into short ones, so that Python objects exist for ``rows`` rows at most."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(column: pa.Array) -> list[str]:
    """Whole texts; a null is an empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def utf8_of(column: pa.Array) -> list[bytes]:
    """Whole texts as UTF-8 bytes, without decoding them; a null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
