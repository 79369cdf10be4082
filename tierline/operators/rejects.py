"""Ingest with a reject path: one scan gives the good rows, the rejects and their counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierline.operators.sinks import DEFAULT_FORMAT, new_version, point_at, write_version
from tierline.session import file_system
from tierline.sources.feeds import INGESTED_AT, provenance
from tierline.functions.columns import stamp
from tierline.specs import FeedSpec

LINE = "line"
_BAD = "_rejected"


class TooManyRejects(ValueError):
    """A load was not published: its share of rejected lines is over the limit."""


@dataclass(frozen=True)
class Loaded:
    """What a load published: both tables and how many lines went to each."""

    table: str
    rejects: str
    n_rows: int
    n_rejects: int


def read_checked(spark: SparkSession, path: str | list[str], spec: FeedSpec, stamp_column: str | None = INGESTED_AT) -> DataFrame:
    """The feed as :func:`~tierline.sources.feeds.read_feed` gives it, with ``line``: the whole
    line where its fields are not as many as the spec's (or don't fit its types), else NULL."""
    schema = StructType([*spec.schema.fields, StructField(LINE, StringType())])
    options = spec.reader_options() | {"columnNameOfCorruptRecord": LINE}
    df = spark.read.schema(schema).options(**options).csv(path)
    extra = [stamp().alias(stamp_column)] if stamp_column else []
    return df.select(*[F.col(f"`{f.name}`") for f in spec.schema], *provenance(), *extra, LINE)


def ingest_with_rejects(
    spark: SparkSession,
    path: str | list[str],
    spec: FeedSpec,
    table: str,
    rejects: str,
    max_share: float | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> Loaded:
    """Load a feed: lines that fit the spec replace ``table``, the others ``rejects`` (file, stamp, line).

    The feed is scanned once and each line is written once: the job writes both
    kinds side by side, each into a folder of its own, counts them on the way,
    and the catalog is then pointed at the two folders. With ``max_share`` a
    load that has a larger share of rejects raises :class:`TooManyRejects` and
    leaves both tables as they were. Calling it again replaces both again.
    An empty feed gives two empty tables. File formats only (not ``delta``).
    """
    df = read_checked(spark, path, spec)
    seen = Observation()
    bad = F.col(LINE).isNotNull()
    counted = df.withColumn(_BAD, bad).observe(seen, F.count_if(bad).alias("n_rejects"), F.count(F.lit(1)).alias("n"))
    folder = new_version(spark, table)
    write_version(counted, folder, fmt, [_BAD])
    n, n_rejects = seen.get["n"], seen.get["n_rejects"]
    if max_share is not None and n_rejects > max_share * n:
        raise TooManyRejects(f"{n_rejects} of {n} lines of {path} don't fit feed {spec.name!r}")
    good = StructType([f for f in df.schema if f.name != LINE])
    left = StructType([f for f in df.schema if f.name not in {*spec.schema.names}])
    for name, columns, value in ((table, good, "false"), (rejects, left, "true")):
        at = f"{folder}/{_BAD}={value}"
        fs, hadoop_path = file_system(spark, at)
        fs.mkdirs(hadoop_path)  # where no line was of this kind
        point_at(spark, name, columns, at, fmt)
    return Loaded(table, rejects, n - n_rejects, n_rejects)
