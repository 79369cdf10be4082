"""Delimited-feed readers, provenance and table scans.

Every reader returns a lazy DataFrame; the scan runs one task per file split
with no shuffle. Declared schemas avoid the extra pass that inference needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierline.functions.columns import stamp
from tierline.specs import FeedSpec

FILE_NAME = "file_name"
FILE_MODIFIED = "file_modified_at"
INGESTED_AT = "ingested_at"


def provenance(with_modified: bool = False) -> list[Column]:
    """Columns taken from the hidden ``_metadata`` struct of a file scan."""
    cols = [F.col("_metadata.file_name").alias(FILE_NAME)]
    if with_modified:
        cols.append(F.col("_metadata.file_modification_time").alias(FILE_MODIFIED))
    return cols


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    spec: FeedSpec,
    with_provenance: bool = True,
    with_modified: bool = False,
    stamp_column: str | None = INGESTED_AT,
) -> DataFrame:
    """Read a delimited feed (file or folder, or several) with the spec's declared schema.

    Names bind by position; the header line, if any, is skipped. Provenance
    (file name, optionally modification time) and an ingest stamp are added.
    """
    df = spark.read.schema(spec.schema).options(**spec.reader_options()).csv(path)
    extra: list[Column] = []
    if with_provenance:
        extra += provenance(with_modified)
    if stamp_column:
        extra.append(stamp().alias(stamp_column))
    return df.select("*", *extra) if extra else df


def read_feed_inferred(spark: SparkSession, path: str, sep: str = ";", with_provenance: bool = True,
                       stamp_column: str | None = INGESTED_AT) -> DataFrame:
    """Read a folder of delimited files with header names and inferred types.

    Inference makes one extra pass over the input; prefer :func:`read_feed`
    for large or recurring loads. Files with different layouts are united by
    position, so keep one feed per folder.
    """
    df = spark.read.options(sep=sep, header="true", inferSchema="true").csv(path)
    extra: list[Column] = provenance() if with_provenance else []
    if stamp_column:
        extra.append(stamp().alias(stamp_column))
    return df.select("*", *extra) if extra else df


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_name, line) of every line of delimited files, whatever their layouts; each file's header is skipped.

    Lines are split by the CSV source, which knows where a file begins in a
    split; a separator that text doesn't hold keeps them whole. Blank lines are
    skipped, as by every CSV read, and a quoted field may not go over its line.
    """
    options = {"sep": "\x01", "quote": "", "escape": "", "comment": "", "header": "true", "enforceSchema": "true"}
    df = spark.read.schema(StructType([StructField("line", StringType())])).options(**options).csv(path)
    return df.select(F.col("_metadata.file_name").alias(FILE_NAME), "line")


def parse_lines(lines: DataFrame, spec: FeedSpec, line: str = "line", stamp_column: str | None = INGESTED_AT) -> DataFrame:
    """Lines of one feed as its columns (by position), the other columns kept;
    ``rejected`` is the line where its fields are not as many as the spec's, else NULL."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema) + ", `_line` STRING"
    options = {k: v for k, v in spec.reader_options().items() if k != "header"} | {"columnNameOfCorruptRecord": "_line"}
    fields = F.from_csv(F.col(line), schema, options)
    kept = [F.col(f"`{c}`") for c in lines.columns if c != line]
    extra = [stamp().alias(stamp_column)] if stamp_column else []
    return lines.withColumn("_fields", fields).select(
        *[F.col("_fields")[f.name].alias(f.name) for f in spec.schema], *kept, *extra, F.col("_fields")["_line"].alias("rejected")
    )


def preview_feed(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Quick look: header names, every column a string, no inference pass."""
    return spark.read.options(sep=sep, header="true").csv(path)


def file_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file below ``path``: path, length, modification time.

    The file content column is pruned from the scan, so only the listing and
    file status are read.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "length",
        F.col("modificationTime").alias("modified_at"),
    )


def only_source_file(df: DataFrame, file_name: str, column: str = FILE_NAME) -> DataFrame:
    """Keep rows read from one source file (pushed to the scan as a metadata filter)."""
    return df.where(F.col(column) == F.lit(file_name))


def only_source_files(df: DataFrame, files: DataFrame, column: str = FILE_NAME) -> DataFrame:
    """Keep rows read from the files of an inventory (or a filtered part of one)."""
    return df.join(files.select(F.col("name").alias("_name")), F.col(column) == F.col("_name"), "left_semi")


def malformed_rows(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """Lines whose number of fields is not the spec's: the columns as read, file name and line.

    A positional read drops surplus fields and fills missing ones with NULL;
    this reports such lines before a load.
    """
    schema = StructType([*spec.schema.fields, StructField("_line", StringType())])
    options = spec.reader_options() | {"columnNameOfCorruptRecord": "_line"}
    df = spark.read.schema(schema).options(**options).csv(path)
    return df.where(F.col("_line").isNotNull()).select("*", F.col("_metadata.file_name").alias(FILE_NAME), F.col("_line").alias("line")).drop("_line")


def read_layer(spark: SparkSession, table: str) -> DataFrame:
    """Scan a layer table by name."""
    return spark.read.table(table)
