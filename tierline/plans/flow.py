"""Ordered layer flows: ingest, refine, aggregate, and rebuild after late rows.

Each step is one Spark job whose only hand-over to the next is the stored
table, like tasks of a job graph: bronze tables for both feeds, then their
silver tables, then customers gold. Steps are plain function calls on one
session; Spark parallelises inside each step.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.batches import put_batch, read_batch
from tierline.operators.gold import BAND, COUNT, KEY, gold_by_key_and_band, partials, sort_desc, window_totals, window_totals_of
from tierline.operators.rejects import Loaded, ingest_with_rejects
from tierline.operators.silver import silver_customers, silver_monolith, silver_products
from tierline.operators.sinks import (
    DEFAULT_FORMAT,
    ensure_database,
    insert_by_name,
    overwrite_table,
    replace_table_as,
)
from tierline.plans.ledger import Ledger
from tierline.session import run_dir
from tierline.sources.feeds import FILE_NAME, parse_lines, read_feed, read_feed_inferred, read_layer, read_lines
from tierline.specs import CUSTOMERS, FEEDS, PRODUCTS, FeedSpec, dataset_name, layer_table, spec_for


NO_FEED = "-"  # lines of files that belong to no feed


@dataclass(frozen=True)
class Target:
    """Where layer tables live: ``[catalog.]database.tab_<dataset>_<layer>``."""

    database: str
    catalog: str | None = None
    fmt: str = DEFAULT_FORMAT
    location: str | None = None

    def table(self, dataset: str, layer: str) -> str:
        return layer_table(dataset, layer, self.database, self.catalog)

    def ensure(self, spark: SparkSession) -> Target:
        ensure_database(spark, self.database, self.location, self.catalog)
        return self


def ingest_bronze(spark: SparkSession, path: str, file_name: str, target: Target) -> str:
    """Feed file or folder -> ``tab_<file name>_bronze``, one table per file; the
    schema is that of the spec whose name the file name contains."""
    df = read_feed(spark, path, spec_for(file_name))
    return overwrite_table(df, target.table(file_name, "bronze"), target.fmt)


def ingest_bronze_checked(spark: SparkSession, path: str, file_name: str, target: Target, max_share: float | None = None) -> Loaded:
    """As :func:`ingest_bronze`, but lines that don't fit the feed go to ``tab_<file name>_rejects``
    instead of losing fields; a load with a larger share of them than ``max_share`` fails unpublished."""
    spec = spec_for(file_name)
    return ingest_with_rejects(spark, path, spec, target.table(file_name, "bronze"), target.table(file_name, "rejects"), max_share, target.fmt)


def ingest_mixed(spark: SparkSession, path: str, target: Target, specs: Sequence[FeedSpec] = tuple(FEEDS.values())) -> dict[str, str]:
    """A folder with files of several feeds -> a bronze table for each; returns ``{feed: table}``
    and, as ``rejects``, the table of the lines that fit none.

    The folder is scanned once, as lines, which are put aside by the feed whose
    name their file's name contains; each feed's lines are then split by its own
    schema. Lines of files of no feed, or with another number of fields, go to
    the rejects with their file's name. A feed without files gives an empty table.
    """
    lines = read_lines(spark, path)
    feed = F.lit(None).cast("string")
    for spec in reversed(specs):  # the first that fits, as in spec_for
        feed = F.when(F.lower(FILE_NAME).contains(spec.name.lower()), F.lit(spec.name)).otherwise(feed)
    at = run_dir(spark, "mixed-lines", uuid.uuid4().hex[:12])
    lines.withColumn("feed", F.coalesce(feed, F.lit(NO_FEED))).write.partitionBy("feed").parquet(at)
    aside = spark.read.schema(f"{FILE_NAME} STRING, line STRING, feed STRING").parquet(at)
    out, left = {}, aside.where(F.col("feed") == F.lit(NO_FEED)).select(FILE_NAME, "line")
    for spec in specs:
        parsed = parse_lines(aside.where(F.col("feed") == F.lit(spec.name)).drop("feed"), spec)
        out[spec.name] = overwrite_table(parsed.where("rejected IS NULL").drop("rejected"), target.table(spec.name, "bronze"), target.fmt)
        left = left.unionByName(parsed.where("rejected IS NOT NULL").select(FILE_NAME, F.col("rejected").alias("line")))
    out["rejects"] = overwrite_table(left, target.table("mixed", "rejects"), target.fmt)
    return out


def build_silver(spark: SparkSession, dataset: str, target: Target) -> str:
    """``tab_<dataset>_bronze`` -> ``tab_<dataset>_silver``."""
    rule = {CUSTOMERS.name: silver_customers, PRODUCTS.name: silver_products}[spec_for(dataset).name]
    silver = rule(read_layer(spark, target.table(dataset, "bronze")))
    return overwrite_table(silver, target.table(dataset, "silver"), target.fmt)


def build_gold(spark: SparkSession, target: Target, dataset: str = CUSTOMERS.name, precision: int = 10) -> str:
    """``tab_<dataset>_silver`` of a customers feed -> its gold table at (key, band) grain.

    An average beyond ``precision`` digits raises under ANSI; widen it for large points.
    """
    if spec_for(dataset) is not CUSTOMERS:
        raise ValueError(f"only customers feeds have a gold table, {dataset!r} is none")
    gold = gold_by_key_and_band(read_layer(spark, target.table(dataset, "silver")), precision=precision)
    return replace_table_as(spark, gold, target.table(dataset, "gold"), target.fmt)


def run_layers(
    spark: SparkSession, feeds: dict[str, str], target: Target, parallel: bool = True, precision: int = 10, ledger: str | None = None
) -> dict[str, str]:
    """Whole flow along the job graph: ``feeds`` maps file name -> path.

    Edges: bronze(x) -> silver(x) for each feed; all silvers -> the gold of each
    customers feed. The per-feed branches have no edge between them, so with
    ``parallel`` they are submitted as concurrent Spark jobs from two driver
    threads (the cluster runs their tasks side by side); gold starts when
    every branch is done. Returns ``{'<dataset>_<layer>': table}``.

    With ``ledger``, a folder that runs share, a flow that failed is called again
    as it was and goes on where it failed: a step whose input and table are those
    of its record isn't done twice (:mod:`tierline.plans.ledger`).
    """
    target.ensure(spark)
    log = Ledger(spark, ledger) if ledger else None

    def step(name: str, inputs: Callable[[], str], make: Callable[[], str]) -> str:
        return log.run(f"{target.database}-{name}", inputs(), make) if log else make()

    def branch(file_name: str, path: str) -> dict[str, str]:
        name = dataset_name(file_name)
        bronze, silver = f"{name}_bronze", f"{name}_silver"
        return {
            bronze: step(bronze, lambda: log.of_files(path), lambda: ingest_bronze(spark, path, file_name, target)),
            silver: step(silver, lambda: log.of_steps(f"{target.database}-{bronze}"), lambda: build_silver(spark, file_name, target)),
        }

    out: dict[str, str] = {}
    if parallel and len(feeds) > 1:
        with ThreadPoolExecutor(max_workers=len(feeds), thread_name_prefix="tierline-branch") as pool:
            for result in [pool.submit(branch, f, p) for f, p in feeds.items()]:
                out.update(result.result())
    else:
        for file_name, path in feeds.items():
            out.update(branch(file_name, path))
    for file_name in feeds:
        if spec_for(file_name) is CUSTOMERS:
            silver, gold = (f"{dataset_name(file_name)}_{layer}" for layer in ("silver", "gold"))
            # gold is made of the silver table alone, but waits for all of them, as the job graph has it
            made = lambda f=file_name: build_gold(spark, target, f, precision)
            out[gold] = step(gold, lambda s=silver: log.of_steps(f"{target.database}-{s}") + f"/{precision}", made)
    return out


# -- single-table ("monolith") flow ------------------------------------------------

def monolith_tables(target: Target) -> dict[str, str]:
    return {layer: target.table("monolith", layer) for layer in ("bronze", "silver", "gold")}


def ingest_monolith_bronze(spark: SparkSession, path: str, target: Target) -> str:
    """Folder of feed files, read with header names and inferred types -> the
    monolith bronze table, with each row's file name and a stamp."""
    return overwrite_table(read_feed_inferred(spark, path), monolith_tables(target)["bronze"], target.fmt)


def build_monolith_silver(spark: SparkSession, target: Target) -> str:
    t = monolith_tables(target)
    return overwrite_table(silver_monolith(read_layer(spark, t["bronze"])), t["silver"], target.fmt)


def build_monolith_gold(spark: SparkSession, target: Target, precision: int = 10) -> str:
    """Key-wide totals per (key, band). A table has no order; see :func:`read_monolith_gold`."""
    t = monolith_tables(target)
    gold = window_totals(read_layer(spark, t["silver"]), precision=precision)
    return replace_table_as(spark, gold, t["gold"], target.fmt)


def read_monolith_gold(spark: SparkSession, target: Target) -> DataFrame:
    """The gold table ordered by count, ties by key and band."""
    return sort_desc(read_layer(spark, monolith_tables(target)["gold"]), COUNT, KEY, BAND)


def rebuild_after_insert(spark: SparkSession, late: DataFrame, target: Target) -> str:
    """Append late rows (a subset of bronze columns) to the monolith bronze table,
    then rebuild silver and gold from it; returns the gold table.

    The insert comes first and is not undone: after a failed rebuild repeat the
    two build steps, not this call, or the rows are inserted twice.
    """
    insert_by_name(late, monolith_tables(target)["bronze"])
    build_monolith_silver(spark, target)
    return build_monolith_gold(spark, target)


# -- the same in batches ---------------------------------------------------------

def load_batch(spark: SparkSession, rows: DataFrame, target: Target, batch: str, precision: int = 10) -> str:
    """Load one batch of bronze rows (any subset of the columns, once the table exists)
    into all monolith layers and refresh gold; returns the gold table.

    Each layer holds the batch as a partition, so a call that failed anywhere,
    or one too many, is simply repeated: the batch is there once. Only the rows
    of this batch are cast and combined. Gold is made from the stored partials
    of all batches, a row per key, band and batch; no earlier bronze or silver
    row is read again.
    """
    t = monolith_tables(target) | {"partials": target.table("monolith", "partials")}
    put_batch(rows, t["bronze"], batch, target.fmt)
    put_batch(silver_monolith(read_batch(spark, t["bronze"], batch)), t["silver"], batch, target.fmt)
    put_batch(partials(read_batch(spark, t["silver"], batch)), t["partials"], batch, target.fmt)
    return refresh_gold(spark, target, precision)


def refresh_gold(spark: SparkSession, target: Target, precision: int = 10) -> str:
    """The gold table of all batches loaded so far, from their partials."""
    gold = window_totals_of(read_layer(spark, target.table("monolith", "partials")), precision)
    return replace_table_as(spark, gold, monolith_tables(target)["gold"], target.fmt)

