"""Tables made of batches: a batch may be loaded any number of times and is there once.

A batch is a partition of its table. Its rows are written to a fresh folder and
the partition is then pointed at it, so a load that is repeated, after a failure
or by mistake, replaces what the earlier one left, and readers see the batch as
it was or as it is. Nothing that other batches hold is read or written.
"""

from __future__ import annotations

from urllib.parse import unquote as unescaped

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.sinks import DEFAULT_FORMAT, aligned_to, new_version, write_version

BATCH = "batch_id"


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def batches_of(spark: SparkSession, table: str) -> list[str]:
    """The batches that a table holds; as many as were loaded, so few against its rows."""
    return sorted(unescaped(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def put_batch(df: DataFrame, table: str, batch: str, fmt: str = DEFAULT_FORMAT) -> str:
    """Make the rows of ``df`` the batch ``batch`` of ``table`` (created with the columns of ``df`` if missing).

    Columns match by name; those not given become NULL, unknown ones raise. A
    batch without rows empties it. Two loads of one batch at once: the last one
    published wins, whole.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema if f.name != BATCH)
        spark.sql(f"CREATE TABLE {table} ({columns}, {BATCH} STRING) USING {fmt} PARTITIONED BY ({BATCH}) LOCATION '{new_version(spark, table)}'")
    schema = spark.table(table).schema
    rows = aligned_to(df.drop(BATCH), type(schema)([f for f in schema if f.name != BATCH]))
    folder = new_version(spark, table)
    write_version(rows, folder, fmt, ())
    part = f"PARTITION ({BATCH} = {_literal(batch)})"
    if batch in batches_of(spark, table):
        spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {part} LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    return table


def read_batch(spark: SparkSession, table: str, batch: str) -> DataFrame:
    """One batch of a table (only its folder is scanned), without the batch column."""
    return spark.table(table).where(F.col(BATCH) == F.lit(batch)).drop(BATCH)
