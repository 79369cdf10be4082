"""Table sinks and catalog helpers.

Tables live in the session catalog. Replaced rows are written as files of their
own and then published in the catalog; inserts use ``insertInto``. Both run as
ordinary Spark write jobs: one task per input partition, files
committed by the output committer, no driver-side data. The table format is a
parameter: ``parquet`` works everywhere; ``delta`` when its package is on the
class path (then schema options are passed straight through).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierline.session import file_system

DEFAULT_FORMAT = "parquet"
#: Folder below a database's location that holds the versions of its tables.
VERSIONS = "_versions"


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def ensure_database(spark: SparkSession, database: str, location: str | None = None, catalog: str | None = None) -> str:
    """``CREATE DATABASE IF NOT EXISTS [catalog.]database``; managed tables go
    below ``location``."""
    loc = f" LOCATION '{location}'" if location else ""
    name = ".".join(quoted(p) for p in (catalog, database) if p)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")
    return database


def name_parts(table: str) -> list[str]:
    """Split a dotted table name; dots inside backticks belong to the part."""
    parts, current, quoted = [], [], False
    for ch in table:
        if ch == "`":
            quoted = not quoted
        elif ch == "." and not quoted:
            parts.append("".join(current))
            current = []
        else:
            current.append(ch)
    parts.append("".join(current))
    return parts


def new_version(spark: SparkSession, table: str) -> str:
    """A fresh folder for one version of a table, below its database's location."""
    *where, name = name_parts(table)
    if where:
        base = spark.catalog.getDatabase(".".join(quoted(p) for p in where)).locationUri
    else:
        base = spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri
    return f"{base.rstrip('/')}/{VERSIONS}/{name}/{uuid.uuid4().hex}"


def write_version(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str]) -> None:
    """Write one version of a table; the only place where rows of a replaced table are written."""
    writer = df.write.format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def _same_shape(spark: SparkSession, table: str, schema: StructType) -> bool:
    """Whether the table is unpartitioned and has these columns, so that its location alone may change."""
    now = [(f.name, f.dataType) for f in spark.table(table).schema]
    plain = not any(c.isPartition for c in spark.catalog.listColumns(table))
    return plain and now == [(f.name, f.dataType) for f in schema]


def overwrite_table(df: DataFrame, table: str, fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] = ()) -> str:
    """Replace a table's rows **and** schema (create it if missing).

    The rows of a file table are written to a fresh folder first, which no
    other writer uses; then the catalog is pointed at it. No data moves. With
    the same columns that is one ``SET LOCATION``, so the table is never absent
    to a reader; with others the table is dropped and created at the new
    folder, and is absent between these two catalog calls. A write job that
    fails leaves the old table whole, and the query may read the table that it
    replaces. The last writer wins. Folders of earlier versions stay for their
    readers until :func:`remove_old_versions`. Delta replaces atomically on its own.
    """
    spark = df.sparkSession
    if fmt == "delta":
        writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
        return table
    path = new_version(spark, table)
    write_version(df, path, fmt, partition_by)
    point_at(spark, table, df.schema, path, fmt, partition_by)
    return table


def point_at(spark: SparkSession, table: str, schema: StructType, path: str, fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] = ()) -> str:
    """Make ``table`` one of these columns whose files are those at ``path``, which are there already.

    With the same columns that is one catalog call; otherwise the table is dropped and created.
    """
    if spark.catalog.tableExists(table):
        if not partition_by and _same_shape(spark, table, schema):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return table
        spark.sql(f"DROP TABLE {table}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    by = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt}{by} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return table


def remove_old_versions(spark: SparkSession, table: str, older_than_hours: float = 168) -> list[str]:
    """Delete folders of earlier versions of ``table`` last written before that; returns them.

    Give a time that no reader or writer still needs: a version that a writer
    has not yet published is as old as its last file.
    """
    at = new_version(spark, table).rpartition("/")[0]
    fs, folder = file_system(spark, at)
    if not fs.exists(folder):
        return []
    used = _locations(spark, table)
    limit, gone = (time.time() - older_than_hours * 3600) * 1000, []
    for status in fs.listStatus(folder):
        path = status.getPath()
        if not any(f"/{path.getName()}/" in f"{u}/" for u in used) and status.getModificationTime() < limit:
            fs.delete(path, True)
            gone.append(path.getName())
    return gone


def _locations(spark: SparkSession, table: str) -> list[str]:
    """Folders that the tables of the same database, and their partitions, read."""
    *where, _ = name_parts(table)
    database = ".".join(quoted(p) for p in where) or spark.catalog.currentDatabase()
    out = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary or t.tableType == "VIEW":
            continue
        name = f"{database}.{quoted(t.name)}"
        told = [spark.sql(f"DESCRIBE FORMATTED {name}")]
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
                parts = [p.partition("=") for p in r[0].split("/")]
                spec = ", ".join(f"{quoted(c)} = '{unquote(v)}'" for c, _, v in parts)
                told.append(spark.sql(f"DESCRIBE FORMATTED {name} PARTITION ({spec})"))
        out += [r["data_type"].rstrip("/") for d in told for r in d.where("col_name = 'Location'").collect()]
    return out


def aligned_to(df: DataFrame, target: StructType) -> DataFrame:
    """Select ``df`` in the target's column order; absent columns become typed NULLs.

    Names match case-insensitively; a source column the target lacks raises.
    """
    source = {c.lower(): c for c in df.columns}
    known = {f.name.lower() for f in target}
    unknown = sorted(set(source) - known)
    if unknown:
        raise ValueError(f"columns not in target table: {unknown}")
    cols = []
    for f in target:
        src = source.get(f.name.lower())
        expr = F.col(quoted(src)) if src is not None else F.lit(None)
        cols.append(expr.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def insert_by_name(df: DataFrame, table: str) -> str:
    """Append rows matching columns by name; columns not given become NULL."""
    spark = df.sparkSession
    aligned_to(df, spark.table(table).schema).write.insertInto(table)
    return table


def insert_values(spark: SparkSession, table: str, columns: Sequence[str], rows: Iterable[Sequence]) -> str:
    """``INSERT INTO t (cols) VALUES ..``: a few literal rows naming a column subset."""
    target = {f.name.lower(): f for f in spark.table(table).schema}
    unknown = [c for c in columns if c.lower() not in target]
    if unknown:
        raise ValueError(f"columns not in target table: {unknown}")
    schema = StructType([target[c.lower()] for c in columns])
    return insert_by_name(spark.createDataFrame(list(rows), schema), table)


def append_evolving(df: DataFrame, table: str, fmt: str = DEFAULT_FORMAT) -> str:
    """Append, adding any new columns to the table first.

    Old rows read NULL in the new columns; columns absent from ``df`` are NULL
    in the new rows. A column whose type differs from the table's raises.
    Creates the table when it does not exist. Not safe against a concurrent
    writer adding the same column.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return overwrite_table(df, table, fmt)
    if fmt == "delta":
        df.write.format("delta").option("mergeSchema", "true").mode("append").saveAsTable(table)
        return table
    current = {f.name.lower(): f for f in spark.table(table).schema}
    conflicts = [
        f.name for f in df.schema if f.name.lower() in current and current[f.name.lower()].dataType != f.dataType
    ]
    if conflicts:
        raise TypeError(f"type differs from table {table} for columns {conflicts}")
    added = [f for f in df.schema if f.name.lower() not in current]
    if added:
        ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ddl})")
        spark.catalog.refreshTable(table)
    return insert_by_name(df, table)


def save_table(df: DataFrame, table: str, mode: str = "overwrite", fmt: str = DEFAULT_FORMAT, stable_name: bool = False) -> str:
    """Overwrite replaces data and schema; append may add columns.

    With ``stable_name`` the table is the name of versions (:mod:`tierline.operators.versions`):
    it is never absent while its columns change; append then takes known columns only.
    """
    if stable_name:
        from tierline.operators.versions import insert_current, publish

        if mode == "append":
            return insert_current(df, table)
        if mode == "overwrite":
            publish(df, table, fmt)
            return table
    if mode == "overwrite":
        return overwrite_table(df, table, fmt)
    if mode == "append":
        return append_evolving(df, table, fmt)
    raise ValueError(f"mode must be 'overwrite' or 'append', got {mode!r}")


def replace_table_as(spark: SparkSession, query: str | DataFrame, table: str, fmt: str = DEFAULT_FORMAT) -> str:
    """Create or replace ``table`` from a query.

    Formats with atomic replace run ``CREATE OR REPLACE TABLE .. AS``; the
    built-in file tables have no REPLACE, so the query result replaces the
    table through :func:`overwrite_table` (write aside, then publish), which
    also lets the query read the table it replaces.
    """
    if fmt == "delta" and isinstance(query, str):
        spark.sql(f"CREATE OR REPLACE TABLE {table} USING delta AS {query}")
        return table
    df = spark.sql(query) if isinstance(query, str) else query
    return overwrite_table(df, table, fmt)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a session view and return a scan of it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")


def show_tables(spark: SparkSession, database: str, include_temporary: bool = True) -> DataFrame:
    """``SHOW TABLES IN db``; like the SQL command it also lists session views
    unless ``include_temporary`` is off."""
    out = spark.sql(f"SHOW TABLES IN {quoted(database)}")
    return out if include_temporary else out.where(~F.col("isTemporary"))
