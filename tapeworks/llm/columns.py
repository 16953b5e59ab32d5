"""What the operators share: new columns computed from Arrow batches, and staged intermediate results."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tapeworks.session import workspace
from tapeworks.sinks.files import staged

# Rows of an Arrow batch; a batch of long texts is worked on in slices of at most SLICE_BYTES, or one text.
BATCH_ROWS = 512
SLICE_BYTES = 8 << 20

# Rows of a file of narrow intermediate results.
FILE_ROWS = 50_000

WORDS = r"[^\x20\x09-\x0D]+"

Compute = Callable[[pa.RecordBatch], Sequence[pa.Array]]


def prepared(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a batch of very long texts still fits a Python worker.

    Python workers look for this package where the driver found it, beside what --py-files gives them.
    """
    home, workers = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if home not in (paths := workers.get("PYTHONPATH", "").split(os.pathsep)):
        workers["PYTHONPATH"] = os.pathsep.join(filter(None, [home, *paths]))
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """The rows, written once to the shared folder and read back; lost executors do not bring the work back.

    With the (largest) number of rows known, the files are no more than hold FILE_ROWS each.
    """
    return staged(df if rows is None else gathered(df, rows), workspace(df.sparkSession, purpose))


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """df, of at most so many narrow rows, in no more partitions than hold FILE_ROWS each."""
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


def slices(batch: pa.RecordBatch, sizes: Sequence[int], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``limit`` bytes each, or of one row."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def regrouped(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in runs of about ``limit`` bytes, or of one row, over the borders of batches.

    Batches are cut by their texts; what is held counts with all its columns, so that rows without texts end too.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in slices(batch, byte_sizes(batch.column(text)), limit):
            if held and size + part.nbytes > limit:
                joined, held, size = pa.Table.from_batches(held).combine_chunks(), [], 0
                yield from joined.to_batches()
            held.append(part)
            size += part.nbytes
    if held:
        joined, held = pa.Table.from_batches(held).combine_chunks(), []
        yield from joined.to_batches()


def byte_sizes(values: pa.Array) -> list[int]:
    """Bytes of each value of a string or binary column; null has none."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_pylist()


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The columns of df but for those that have one of the names, in any case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def add_columns(df: DataFrame, text: str, fields: T.StructType, make: Callable[[], Compute],
                keep: Sequence[str] | None = None, over: int | None = None) -> DataFrame:
    """df with columns that ``make()(batch)`` computes from the rows of each slice.

    ``make`` runs once in a task, so what it builds (automata, caches) serves all the task's rows. Columns of df
    that have the name of a new one are replaced. ``keep`` names the columns to return beside the new ones. Slices of
    ``over`` bytes, if given, go over the borders of batches.
    """
    kept = [c for c in without(df, fields.names) if keep is None or c in keep]
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        if over is None:
            parts = (part for batch in batches for part in slices(batch, byte_sizes(batch.column(text))))
        else:
            parts = regrouped(batches, text, over)
        for part in parts:
            new = compute(part)
            columns = [part.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [a if a.type == f.type else a.cast(f.type) for a, f in zip([*columns, *new], arrow)],
                schema=arrow,
            )

    needed = list(dict.fromkeys([*kept, *(c for c in df.columns if c == text)]))
    return df.select(*needed).mapInArrow(run, schema)
