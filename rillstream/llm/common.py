"""Helpers shared by the text operators: tables, spilled intermediates and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from rillstream.session import fresh_path

#: Bytes of text that a Python task holds as Python objects at a time (one longer text goes alone).
SLICE_BYTES = 4 << 20
#: Bytes that go to a Python task, and come into Spark's Arrow buffers, at a time; Spark's own bound is 64 MB for each task.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session end at BATCH_BYTES, where no lower bound is set; results don't depend on it.

    Spark keeps idle Python workers, so an executor has several times as many as cores, and each keeps what its largest batches took.
    """
    held = spark.conf.get(_BATCH).lower()
    if not held.removesuffix("b").isdigit() or int(held.removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, BATCH_BYTES)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, in ``small_batches``.

    The lineage ends here, the size is known to the planner, and a join with the
    result has a plain exchange on either side, which adaptive execution can split.
    """
    small_batches(df.sparkSession)
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about SLICE_BYTES of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        start = held = 0
        for row, length in enumerate(lengths):
            if held and held + length > SLICE_BYTES:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        yield batch.slice(start)


def per_slice(function: Callable[[dict[str, list]], dict[str, list]], schema: pa.Schema,
              column: str = "text") -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function out of one from columns to columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column):
            out = function(part.to_pydict())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[field.name], field.type) for field in schema], schema=schema)

    return run
