"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.session import run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without its columns of these names (in any letter case)."""
    lower = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lower])


def append_columns(
    df: DataFrame,
    column: str,
    outputs: T.StructType,
    compute: Callable[[pa.Array], list[pa.Array]],
) -> DataFrame:
    """``df`` with ``outputs`` appended, computed from one column by Arrow batch.

    Rows, their order within a partition and all other columns stay as they
    are; an input column that has the name of an output is replaced by it.
    """
    kept = without(df, outputs.fieldNames())
    schema = T.StructType([*kept.schema.fields, *outputs.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            for some in runs(batch, at):
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, *compute(some.column(at))], names=[*batch.schema.names, *outputs.fieldNames()]
                )

    return kept.mapInArrow(run, schema)


def runs(batch: pa.RecordBatch, column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``size`` bytes of one column, so a task's memory has a bound."""
    if not batch.num_rows:
        return
    values, kind = batch.column(column), batch.schema.field(column).type
    if pa.types.is_primitive(kind):
        yield batch
        return
    length = pc.multiply(pc.list_value_length(values), 4) if pa.types.is_list(kind) else pc.binary_length(values)
    bytes_of = pc.fill_null(length, 0).to_numpy(zero_copy_only=False)
    of = np.cumsum(bytes_of, dtype=np.int64) // size
    starts = np.flatnonzero(np.diff(of, prepend=of[0] - 1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(int(a), int(b - a))


RELEASE_S = 0.5
_RELEASED = [0.0]


def released(often: bool = True) -> None:
    """What was freed goes back to the system, else a worker keeps it while it waits for its next task."""
    if not often and time.monotonic() - _RELEASED[0] < RELEASE_S:
        return
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)
    _RELEASED[0] = time.monotonic()


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches, that gives back its memory at the end."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            released()

    return tidied


def tidy_group(run: Callable) -> Callable:
    """``run`` over one group, that gives back its memory; not after each of many small groups."""

    def tidied(rows):
        try:
            return run(rows)
        finally:
            released(often=False)

    return tidied


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and read back.

    What is read back has no lineage beyond the files, so a lost executor costs
    a re-read, and two consumers do not compute the input twice.
    """
    spark = df.sparkSession
    path = run_dir(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(texts: list[str | None], chars: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts (null: empty) of about ``chars`` characters, with their first index."""
    start, run, size = 0, [], 0
    for i, text in enumerate(texts):
        run.append(text or "")
        size += len(run[-1])
        if size >= chars:
            yield start, run
            start, run, size = i + 1, [], 0
    if run:
        yield start, run
