"""Feeds derived from the driver's parquet tables.

The source feeds (a customers file and a products file) are not available,
so stand-ins are derived from the benchmark tables with plain expressions:

* **participation** (customers feed: ``UUID;Name;Points``), one row per event;
* **product feed** (products feed: ``1;ChatMessage;Mensagem_do_chat_da_Twitch``),
  one row per part.

Every value is a pure function of one input row, so the derivation is a
single narrow projection (no shuffle) and grows with the input. The same rules
are written in SQL in :mod:`tierline.plans.oracle` for the DuckDB check.
"""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import file_system, files_of, run_dir, shared_dir
from tierline.specs import CUSTOMERS, PRODUCTS, FeedSpec

# Bump when a derivation rule changes, so staged copies are not reused.
DERIVATION_VERSION = "2"
#: Unfinished staging folders of other runs older than this are removed.
STALE_HOURS = 24


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# Read schemas of the driver columns used here. Giving them up front skips
# the footer read for schema discovery on the driver; parquet still resolves
# columns by name and reads only these.
EVENTS_COLUMNS = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
PART_COLUMNS = "p_partkey BIGINT, p_name STRING, p_type STRING"

# One SQL expression per feed column (a single analysed projection).
PARTICIPATION_EXPRS = (
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS UUID",
    "CASE WHEN event_id % 53 = 0 THEN concat(' ', event_type, '_', CAST(user_id AS STRING), ' x') "
    "WHEN event_id % 59 = 0 THEN concat('_', event_type, '_', CAST(user_id AS STRING), ' x') "
    "ELSE concat(event_type, '_', CAST(user_id AS STRING), ' x') END AS Name",
    "CASE WHEN event_id % 37 = 0 THEN 'n/a' "
    "WHEN event_id % 41 = 0 THEN concat(CAST(event_id AS STRING), '.5') "
    "WHEN event_id % 43 = 0 THEN NULL "
    "WHEN event_id % 47 = 0 THEN '2000' "
    "ELSE CAST(floor(value * 100) AS STRING) END AS Points",
)


#: A name for each event, short for every third member.
OWN_NAMES = "concat(CASE WHEN user_id % 3 = 0 THEN 'M' ELSE 'Longer-than-a-code-' END, CAST(event_id AS STRING)) AS Name"


def participation(spark: SparkSession, sf_dir: str, where: str | None = None, names: str = PARTICIPATION_EXPRS[1]) -> DataFrame:
    """Customers-feed stand-in from ``events``; every column is a string.

    The event id picks edge cases deterministically (no row is dropped):
    a NULL key, names with a leading blank or ``_``, non-numeric, fractional
    and NULL points, and the band boundary 2000.
    """
    ev = spark.read.schema(EVENTS_COLUMNS).parquet(table_path(sf_dir, "events"))
    return (ev.where(where) if where else ev).selectExpr(PARTICIPATION_EXPRS[0], names, PARTICIPATION_EXPRS[2])


def product_feed(spark: SparkSession, sf_dir: str, where: str | None = None) -> DataFrame:
    """Products-feed stand-in from ``part``."""
    part = spark.read.schema(PART_COLUMNS).parquet(table_path(sf_dir, "part"))
    return (part.where(where) if where else part).selectExpr(
        "CAST(p_partkey AS STRING) AS `1`",
        "p_type AS ChatMessage",
        "p_name AS Mensagem_do_chat_da_Twitch",
    )


def late_rows(spark: SparkSession, sf_dir: str, points: str = "250") -> DataFrame:
    """Late arrivals: one ``(UUID, Points)`` row per known member key.

    Only two of the bronze columns are given, as in a partial insert.
    """
    return (
        participation(spark, sf_dir)
        .where(F.col("UUID").isNotNull())
        .select("UUID")
        .distinct()
        .select("UUID", F.lit(points).alias("Points"))
    )


def derive_feed(spark: SparkSession, sf_dir: str, spec: FeedSpec, where: str | None = None) -> DataFrame:
    if spec.name == CUSTOMERS.name:
        return participation(spark, sf_dir, where)
    if spec.name == PRODUCTS.name:
        return product_feed(spark, sf_dir, where)
    raise ValueError(f"no derivation for feed {spec.name!r}")


def write_feed(df: DataFrame, path: str, spec: FeedSpec) -> None:
    """Write a frame as a delimited feed folder (one header per part file).

    Outer blanks are kept (the CSV writer trims them by default).
    """
    (
        df.write.mode("overwrite")
        .option("sep", spec.sep)
        .option("header", str(spec.header).lower())
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


#: CSV options for lines as they are: a separator that no line holds, no quotes.
WHOLE_LINES = {"sep": "\x01", "quote": ""}
#: SQL over the feed's columns and event_id: the line of a row, some with a field too many or too few.
BROKEN_LINE = (
    "CASE WHEN event_id % 29 = 0 THEN concat_ws(';', coalesce(UUID, ''), Name, coalesce(Points, ''), 'surplus') "
    "WHEN event_id % 31 = 0 THEN concat_ws(';', coalesce(UUID, ''), Name) "
    "ELSE concat_ws(';', coalesce(UUID, ''), Name, coalesce(Points, '')) END"
)


def broken_feed(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the customers feed with lines that have a field too many (every 29th event) or too few (every 31st)."""
    ev = spark.read.schema(EVENTS_COLUMNS).parquet(table_path(sf_dir, "events"))
    lines = ev.selectExpr("event_id", *PARTICIPATION_EXPRS).select(F.expr(BROKEN_LINE).alias(CUSTOMERS.sep.join(CUSTOMERS.schema.names)))
    path = run_dir(spark, "broken", uuid.uuid4().hex[:12])
    lines.write.option("header", "true").options(**WHOLE_LINES).csv(path)
    return path


def staged_feed(spark: SparkSession, sf_dir: str, spec: FeedSpec, where: str | None = None) -> str:
    """Path of the derived feed (of the source rows that ``where`` keeps) written as CSV under the shared work folder.

    The folder name is a digest of the source table's files, so a finished copy
    is reused. Each run writes into a folder of its own and then marks it as the
    feed's by a small file; what no run marked is removed by the next one.
    """
    source = table_path(sf_dir, "events" if spec.name == CUSTOMERS.name else "part")
    digest = hashlib.sha1(
        f"{DERIVATION_VERSION}|{spec.name}|{where}|{files_of(spark, source)}".encode()
    ).hexdigest()[:16]
    root = shared_dir(spark, "feeds", f"{spec.name}-{digest}")
    fs, hpath = file_system(spark, root)
    current = file_system(spark, f"{root}/current")[1]
    if fs.exists(current):
        return f"{root}/{fs.listStatus(current)[0].getPath().getName()}"
    name = f"v-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
    if fs.exists(hpath):
        own = f"v-{spark.sparkContext.applicationId}-"
        limit = (time.time() - STALE_HOURS * 3600) * 1000
        for status in fs.listStatus(hpath):  # left by runs that died
            left = status.getPath().getName()
            if left != "current" and not left.startswith(own) and status.getModificationTime() < limit:
                fs.delete(status.getPath(), True)
    write_feed(derive_feed(spark, sf_dir, spec, where), f"{root}/{name}", spec)
    fs.create(file_system(spark, f"{root}/current/{name}")[1], True).close()
    return f"{root}/{name}"


def mixed_folder(spark: SparkSession, sf_dir: str) -> str:
    """One folder with the files of both feeds side by side (``customers-0.csv``, ``products-0.csv`` ..)."""
    root = run_dir(spark, "mixed", uuid.uuid4().hex[:12])
    for spec in (CUSTOMERS, PRODUCTS):
        write_feed(derive_feed(spark, sf_dir, spec), f"{root}-{spec.name}", spec)
        fs, made = file_system(spark, f"{root}-{spec.name}")
        fs.mkdirs(file_system(spark, root)[1])
        parts = sorted(str(s.getPath()) for s in fs.listStatus(made) if s.getPath().getName().startswith("part-"))
        for i, part in enumerate(parts):
            fs.rename(file_system(spark, part)[1], file_system(spark, f"{root}/{spec.name}-{i}.csv")[1])
    return root
