"""Registered queries: one per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole driver tables (or data Spark derives from them). Clock and file-name
columns vary between runs, so a query either drops them or reports a stable
fact about them (``has_source_file``, ``stamped``), which keeps its result
comparable with :mod:`tierline.plans.oracle`.

Queries that write tables use a database private to the call, placed under the shared work folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions.columns import (
    BAND_LABELS,
    BAND_LABELS_PT,
    INVALID_LABEL,
    INVALID_LABEL_PT,
    band,
    first_name,
    first_name_unguarded,
    first_token_upper,
    stamp,
    to_decimal,
    to_int,
)
from tierline.functions.udf import first_name_arrow
from tierline.operators import gold as G
from tierline.operators.batches import put_batch
from tierline.operators.landing import land_inferred
from tierline.operators.silver import silver_customers, silver_monolith, silver_products
from tierline.operators.sinks import (
    append_evolving,
    insert_by_name,
    insert_values,
    overwrite_table,
    register_view,
    replace_table_as,
    save_table,
)
from tierline.operators.versions import current_version, publish
from tierline.plans.flow import (
    Target,
    build_monolith_gold,
    build_monolith_silver,
    build_silver,
    ingest_bronze,
    ingest_bronze_checked,
    ingest_mixed,
    ingest_monolith_bronze,
    load_batch,
    monolith_tables,
    read_monolith_gold,
    rebuild_after_insert,
    run_layers,
)
from tierline.session import run_dir
from tierline.sources.derived import OWN_NAMES, broken_feed, late_rows, mixed_folder, participation, product_feed, staged_feed
from tierline.sources.feeds import (
    FILE_MODIFIED,
    FILE_NAME,
    INGESTED_AT,
    file_inventory,
    only_source_files,
    preview_feed,
    read_feed,
    read_feed_inferred,
    read_layer,
)
from tierline.specs import CUSTOMERS, PRODUCTS

Query = Callable[[SparkSession, str], DataFrame]


# -- shared inputs ------------------------------------------------------------

_MADE: list[str] = []


def _target(spark: SparkSession, name: str) -> Target:
    """A database for one call of one query, private to this application; it stays
    until :func:`drop_databases`, so results of earlier calls can still be read."""
    app = re.sub(r"[^a-z0-9_]", "_", spark.sparkContext.applicationId.lower())
    db = f"tl_{name}_{app}_{uuid.uuid4().hex[:6]}"
    _MADE.append(db)
    return Target(database=db, location=run_dir(spark, "warehouse", db)).ensure(spark)


def drop_databases(spark: SparkSession) -> None:
    """Drop what the queries of this application wrote, once their results are read."""
    while _MADE:
        spark.sql(f"DROP DATABASE IF EXISTS {_MADE.pop()} CASCADE")


def _monolith_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_monolith(participation(spark, sf_dir))


def _customers_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_customers(participation(spark, sf_dir), with_stamp=False)


def _source_flag(df: DataFrame) -> DataFrame:
    """Replace run-dependent provenance/stamp columns by stable facts."""
    return df.select(
        *[c for c in df.columns if c not in (FILE_NAME, INGESTED_AT)],
        F.col(FILE_NAME).endswith(".csv").alias("has_source_file"),
    )


GOLD_STABLE = [G.KEY, G.NAME, G.COUNT, G.TOTAL, G.AVG, G.MIN, G.MAX, G.BAND]


# -- scans and sources --------------------------------------------------------

def q_scan_csv_schema(spark, sf_dir):
    path = staged_feed(spark, sf_dir, CUSTOMERS)
    return _source_flag(read_feed(spark, path, CUSTOMERS))


def q_scan_csv_infer_dir(spark, sf_dir):
    return _source_flag(read_feed_inferred(spark, staged_feed(spark, sf_dir, CUSTOMERS)))


def q_scan_csv_preview(spark, sf_dir):
    return preview_feed(spark, staged_feed(spark, sf_dir, CUSTOMERS))


def _parts(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The customers feed as two files: rows of even and of odd events."""
    return {
        "customers_even.csv": staged_feed(spark, sf_dir, CUSTOMERS, "event_id % 2 = 0"),
        "customers_odd.csv": staged_feed(spark, sf_dir, CUSTOMERS, "event_id % 2 <> 0"),
    }


def q_scan_file_provenance(spark, sf_dir):
    """Every row's file is in the folder's inventory and has a time."""
    path = staged_feed(spark, sf_dir, CUSTOMERS)
    files = file_inventory(spark, path, glob="*.csv").select(F.col("name").alias("_name"))
    feed = read_feed(spark, path, CUSTOMERS, with_modified=True)
    return feed.join(files, F.col(FILE_NAME) == F.col("_name"), "left").select(
        "UUID", "Name", "Points", F.col("_name").isNotNull().alias("file_listed"),
        F.col(FILE_MODIFIED).isNotNull().alias("file_dated"), F.col(INGESTED_AT).isNotNull().alias("stamped"),
    )


def q_filter_by_source_file(spark, sf_dir):
    """Both parts of the feed are read; the rows of one part's files stay."""
    paths = _parts(spark, sf_dir)
    feed = read_feed(spark, list(paths.values()), CUSTOMERS)
    kept = only_source_files(feed, file_inventory(spark, paths["customers_even.csv"], glob="*.csv"))
    return kept.select("UUID", "Name", "Points")


def q_scan_layer_table(spark, sf_dir):
    t = _target(spark, "scan_layer_table")
    table = ingest_bronze(spark, staged_feed(spark, sf_dir, CUSTOMERS), "customers.csv", t)
    return read_layer(spark, table).drop(FILE_NAME, INGESTED_AT)


# -- sinks --------------------------------------------------------------------

def q_sink_overwrite(spark, sf_dir):
    t = _target(spark, "sink_overwrite")
    table = t.table("customers", "bronze")
    feed = participation(spark, sf_dir)
    overwrite_table(feed, table)
    overwrite_table(feed, table)  # a second overwrite leaves the same table
    return read_layer(spark, table)


def q_sink_overwrite_schema(spark, sf_dir):
    t = _target(spark, "sink_overwrite_schema")
    table = t.table("customers", "silver")
    save_table(product_feed(spark, sf_dir), table, "overwrite")  # another schema first
    save_table(_customers_silver(spark, sf_dir), table, "overwrite")
    return read_layer(spark, table)


def q_sink_append_evolve(spark, sf_dir):
    t = _target(spark, "sink_append_evolve")
    table = t.table("customers", "bronze")
    overwrite_table(participation(spark, sf_dir), table)
    late = late_rows(spark, sf_dir).withColumn("arrival", F.lit("late"))
    append_evolving(late, table)
    return read_layer(spark, table)


def q_sink_ctas_replace(spark, sf_dir):
    """Create, then replace a table from a query: how many members each band has per first name."""
    t = _target(spark, "sink_ctas_replace")
    register_view(_customers_silver(spark, sf_dir), "tl_customers_silver_v")
    table = t.table("customers", "gold")
    replace_table_as(spark, "SELECT DISTINCT band FROM tl_customers_silver_v", table)  # other columns first
    query = "SELECT band, first_name, COUNT(*) AS entries, SUM(points) AS points FROM tl_customers_silver_v GROUP BY ALL"
    replace_table_as(spark, query, table)
    replace_table_as(spark, query, table)  # the same columns again
    return read_layer(spark, table)


def q_sink_insert_partial(spark, sf_dir):
    t = _target(spark, "sink_insert_partial")
    table = t.table("monolith", "bronze")
    overwrite_table(participation(spark, sf_dir), table)
    insert_by_name(late_rows(spark, sf_dir), table)  # (UUID, Points) only: Name is NULL
    return read_layer(spark, table)


def q_temp_view(spark, sf_dir):
    return register_view(G.per_key_totals(_monolith_silver(spark, sf_dir)), "tl_media_points")


#: Rows for the inline insert: two of the columns, a repeated row, a NULL.
INLINE_ROWS = [("7", "250"), ("8", "1750"), ("7", "250"), ("9", None)]


def q_sink_insert_values(spark, sf_dir):
    """Literal rows of two columns into a full bronze table: the others, provenance and stamp too, are NULL."""
    t = _target(spark, "sink_insert_values")
    table = ingest_bronze(spark, staged_feed(spark, sf_dir, CUSTOMERS), "customers.csv", t)
    insert_values(spark, table, ["UUID", "Points"], INLINE_ROWS)
    return read_layer(spark, table).select(
        "UUID", "Name", "Points", F.col(FILE_NAME).isNotNull().alias("has_file"), F.col(INGESTED_AT).isNotNull().alias("stamped")
    )


# -- projections, predicates, functions ---------------------------------------

def q_project_star_plus(spark, sf_dir):
    df = participation(spark, sf_dir).select("*", stamp().alias(INGESTED_AT))
    return df.select(*[c for c in df.columns if c != INGESTED_AT], F.col(INGESTED_AT).isNotNull().alias("stamped"))


def q_project_rename(spark, sf_dir):
    return silver_products(product_feed(spark, sf_dir), with_stamp=False)


def q_project_with_columns(spark, sf_dir):
    return (
        participation(spark, sf_dir)
        .withColumn("first_name", first_token_upper("Name"))
        .withColumn("first_name", first_name("Name"))  # replaces the column above
        .withColumn("points_int", to_int("Points"))
    )


def q_project_chained(spark, sf_dir):
    return (
        participation(spark, sf_dir)
        .withColumn("points_int", to_int("Points"))
        .withColumn("band", band("points_int", closed_top=True))
        .withColumn("is_top", F.col("band") == F.lit(BAND_LABELS[-1]))
    )


def q_silver_customers(spark, sf_dir):
    return _customers_silver(spark, sf_dir)


def q_project_drop(spark, sf_dir):
    return read_feed(spark, staged_feed(spark, sf_dir, CUSTOMERS), CUSTOMERS).drop(FILE_NAME, INGESTED_AT)


def q_stamp_ingestion(spark, sf_dir):
    """Stored stamps of the three layers: one per load, none before the layer that it was made from."""
    t = _target(spark, "stamp_ingestion")
    tables = run_layers(spark, {"customers.csv": staged_feed(spark, sf_dir, CUSTOMERS)}, t)
    told = None
    for place, (layer, key) in enumerate((("bronze", "UUID"), ("silver", G.KEY), ("gold", G.KEY))):
        one = read_layer(spark, tables[f"customers_{layer}"]).agg(
            F.count(F.lit(1)).alias("row_count"), F.count(key).alias("keyed_rows"),
            F.count_distinct(INGESTED_AT).alias("stamps"), F.min(INGESTED_AT).alias("_at"),
        ).withColumns({"layer": F.lit(layer), "_place": F.lit(place)})
        told = one if told is None else told.unionByName(one)
    before = F.lag("_at").over(Window.orderBy("_place"))  # three rows
    return told.select("layer", "row_count", "keyed_rows", "stamps", F.coalesce(F.col("_at") > before, F.lit(True)).alias("in_order"))


def q_case_insensitive_columns(spark, sf_dir):
    return participation(spark, sf_dir).select(F.col("uuid"), F.col("name"), to_int("points").alias("points_int"))


def q_predicate_range(spark, sf_dir):
    p = to_int("Points")
    return participation(spark, sf_dir).select("UUID", p.alias("points_int")).where(
        (F.col("points_int") >= 1000) & (F.col("points_int") <= 2000)
    )


def q_predicate_is_null(spark, sf_dir):
    return participation(spark, sf_dir).select("UUID", "Points", to_int("Points").isNull().alias("invalid_points"))


def q_case_when(spark, sf_dir):
    p = to_int("Points")
    return participation(spark, sf_dir).select(
        "UUID", "Points", band(p, labels=BAND_LABELS_PT, invalid_label=INVALID_LABEL_PT).alias("band")
    )


def q_band_half_open(spark, sf_dir):
    return participation(spark, sf_dir).select("UUID", "Points", band(to_int("Points")).alias("band"))


def q_band_closed(spark, sf_dir):
    return participation(spark, sf_dir).select("UUID", "Points", band(to_int("Points"), closed_top=True).alias("band"))


def q_band_unguarded(spark, sf_dir):
    return participation(spark, sf_dir).select(
        "UUID", "Points", band(to_int("Points"), closed_top=True, invalid_label=None).alias("band")
    )


def q_first_name(spark, sf_dir):
    return participation(spark, sf_dir).select("Name", first_name("Name").alias("first_name"))


def q_first_name_no_guard(spark, sf_dir):
    return participation(spark, sf_dir).select("Name", first_name_unguarded("Name").alias("first_name"))


def q_first_token_upper(spark, sf_dir):
    return participation(spark, sf_dir).select("Name", first_token_upper("Name").alias("first_token"))


def q_first_name_udf(spark, sf_dir):
    return participation(spark, sf_dir).select("Name", first_name_arrow(F.col("Name")).alias("first_name"))


def q_try_cast_int(spark, sf_dir):
    return participation(spark, sf_dir).select("Points", to_int("Points").alias("points_int"))


def q_cast_decimal(spark, sf_dir):
    silver = _monolith_silver(spark, sf_dir)
    return silver.groupBy(F.col("UUID").alias(G.KEY)).agg(to_decimal(F.avg("points_int")).alias(G.AVG))


def q_split_get_item(spark, sf_dir):
    return participation(spark, sf_dir).select(
        "Name",
        F.split("Name", " ").getItem(0).alias("before_space"),
        F.split("Name", "_").getItem(0).alias("before_underscore"),
    )


# -- aggregates, join, windows, sort ------------------------------------------

def q_agg_per_key(spark, sf_dir):
    return G.per_key_totals(_monolith_silver(spark, sf_dir))


def q_gold_by_key_and_band(spark, sf_dir):
    return G.gold_by_key_and_band(_customers_silver(spark, sf_dir), with_stamp=False)


def q_gold_many_names(spark, sf_dir):
    """Gold where each event has a name of its own; for two members in three they are longer than a code holds."""
    silver = participation(spark, sf_dir, names=OWN_NAMES).select(
        F.col("UUID").alias(G.KEY), F.col("Name").alias(G.NAME), to_int("Points").alias("points"), band(to_int("Points")).alias(G.BAND)
    )
    return G.gold_by_key_and_band(silver, with_stamp=False, many_names=True)


def q_group_by_all(spark, sf_dir):
    register_view(_monolith_silver(spark, sf_dir), "tl_monolith_silver_v")
    return G.group_by_all_sql(spark, "tl_monolith_silver_v")


def q_count_column_nulls(spark, sf_dir):
    silver = _monolith_silver(spark, sf_dir)
    return silver.groupBy(F.col("UUID").alias(G.KEY)).agg(
        F.count("UUID").alias("key_count"), F.count(F.lit(1)).alias("row_count"), F.sum("points_int").alias(G.TOTAL)
    )


def q_agg_all_null_group(spark, sf_dir):
    gold = G.gold_by_key_and_band(_customers_silver(spark, sf_dir), with_stamp=False)
    return gold.where(F.col(G.BAND) == F.lit(INVALID_LABEL))


def q_distinct_values(spark, sf_dir):
    return G.distinct_values(participation(spark, sf_dir), "Points")


def q_validate_join_left(spark, sf_dir):
    return G.validation_report(_monolith_silver(spark, sf_dir), ordered=False)


def q_window_totals(spark, sf_dir):
    return G.window_totals(_monolith_silver(spark, sf_dir))


def q_gold_window(spark, sf_dir):
    t = _target(spark, "gold_window")
    overwrite_table(participation(spark, sf_dir), monolith_tables(t)["bronze"])
    build_monolith_silver(spark, t)
    build_monolith_gold(spark, t)
    return read_monolith_gold(spark, t)


def q_window_each_aggregate(spark, sf_dir):
    silver = _monolith_silver(spark, sf_dir).select("UUID", "first_name_split", "points_int")
    return G.with_key_totals(silver)


def q_sort_desc_alias(spark, sf_dir):
    report = G.validation_report(_monolith_silver(spark, sf_dir), ordered=False)
    return G.sort_desc(report, G.COUNT, G.KEY, G.NAME, G.BAND)


# -- composite flows ----------------------------------------------------------

def q_bronze_customers(spark, sf_dir):
    t = _target(spark, "bronze_customers")
    table = ingest_bronze(spark, staged_feed(spark, sf_dir, CUSTOMERS), "customers.csv", t)
    return _source_flag(read_layer(spark, table))


def q_bronze_with_rejects(spark, sf_dir):
    """A feed with broken lines in one load: the rows that fit, the lines that don't, and how many of each the job counted."""
    t = _target(spark, "bronze_with_rejects")
    loaded = ingest_bronze_checked(spark, broken_feed(spark, sf_dir), "customers.csv", t)
    good = read_layer(spark, loaded.table).select("UUID", "Name", "Points", F.lit(None).cast("string").alias("line"))
    rejects = read_layer(spark, loaded.rejects).select(*[F.lit(None).cast("string").alias(c) for c in ("UUID", "Name", "Points")], "line")
    counts = [F.lit(loaded.n_rows).cast("long").alias("n_rows"), F.lit(loaded.n_rejects).cast("long").alias("n_rejects")]
    return good.unionByName(rejects).select("*", *counts)


def q_bronze_products(spark, sf_dir):
    t = _target(spark, "bronze_products")
    table = ingest_bronze(spark, staged_feed(spark, sf_dir, PRODUCTS), "products.csv", t)
    return _source_flag(read_layer(spark, table))


def q_silver_products(spark, sf_dir):
    t = _target(spark, "silver_products")
    ingest_bronze(spark, staged_feed(spark, sf_dir, PRODUCTS), "products.csv", t)
    return read_layer(spark, build_silver(spark, "products", t)).drop(INGESTED_AT)


def q_silver_monolith(spark, sf_dir):
    return _monolith_silver(spark, sf_dir)


def q_rebuild_after_insert(spark, sf_dir):
    t = _target(spark, "rebuild_after_insert")
    overwrite_table(participation(spark, sf_dir), monolith_tables(t)["bronze"])
    gold = rebuild_after_insert(spark, late_rows(spark, sf_dir), t)
    return read_layer(spark, gold)


def q_batch_repeated(spark, sf_dir):
    """Late rows loaded twice under one batch name are in bronze once."""
    t = _target(spark, "batch_repeated")
    bronze = monolith_tables(t)["bronze"]
    put_batch(participation(spark, sf_dir), bronze, "first")
    for _ in range(2):
        put_batch(late_rows(spark, sf_dir), bronze, "late")
    return read_layer(spark, bronze)


def q_gold_by_batches(spark, sf_dir):
    """Gold from the partials of two batches, the second loaded twice; no bronze row of the first is read for it."""
    t = _target(spark, "gold_by_batches")
    load_batch(spark, participation(spark, sf_dir), t, "first")
    for _ in range(2):
        gold = load_batch(spark, late_rows(spark, sf_dir), t, "late")
    return read_layer(spark, gold)


def q_sink_stable_name(spark, sf_dir):
    """One name over versions of other columns; late rows go into the version that it stands for."""
    t = _target(spark, "sink_stable_name")
    name = t.table("customers", "silver")
    save_table(product_feed(spark, sf_dir), name, "overwrite", stable_name=True)
    publish(_customers_silver(spark, sf_dir), name, based_on=current_version(spark, name))
    late = late_rows(spark, sf_dir).select(F.col("UUID").alias("member_id"), to_int("Points").alias("points"))
    save_table(late, name, "append", stable_name=True)
    return read_layer(spark, name)


def q_mixed_folder(spark, sf_dir):
    """Both feeds in one folder: each line lands in its own feed's table, under its own columns."""
    tables = ingest_mixed(spark, mixed_folder(spark, sf_dir), _target(spark, "mixed_folder"))
    members = read_layer(spark, tables["customers"]).select(F.lit("customers").alias("feed"), F.col("UUID").alias("a"), F.col("Name").alias("b"), F.col("Points").alias("c"))
    items = read_layer(spark, tables["products"]).toDF("a", "b", "c", FILE_NAME, INGESTED_AT).select(F.lit("products").alias("feed"), "a", "b", "c")
    left = read_layer(spark, tables["rejects"]).select(F.lit("rejects").alias("feed"), F.col(FILE_NAME).alias("a"), F.col("line").alias("b"), F.lit(None).cast("string").alias("c"))
    return members.unionByName(items).unionByName(left)


def q_scan_infer_once(spark, sf_dir):
    """Header names and inferred types from the one scan that lands the lines."""
    t = _target(spark, "scan_infer_once")
    table = t.table("customers", "bronze")
    land_inferred(spark, staged_feed(spark, sf_dir, CUSTOMERS), table, t.table("customers_landed", "bronze"))
    return _source_flag(read_layer(spark, table))


def q_layers_resumed(spark, sf_dir):
    """The whole flow, called again as it was: the second call finds every step done."""
    t = _target(spark, "layers_resumed")
    feeds = {"customers.csv": staged_feed(spark, sf_dir, CUSTOMERS), "products.csv": staged_feed(spark, sf_dir, PRODUCTS)}
    ledger = run_dir(spark, "ledger", t.database)
    first = run_layers(spark, feeds, t, ledger=ledger)
    stamps = [read_layer(spark, x).select(F.max(INGESTED_AT)) for x in (first["customers_bronze"], first["customers_gold"])]
    before = [s.first()[0] for s in stamps]
    again = run_layers(spark, feeds, t, ledger=ledger)
    if first != again or before != [s.first()[0] for s in stamps]:
        raise ValueError("a finished step was done again")
    return read_layer(spark, again["customers_gold"]).select(*GOLD_STABLE)


def q_monolith_end_to_end(spark, sf_dir):
    """Folder -> bronze with inferred types -> inline insert -> silver without provenance -> gold."""
    t = _target(spark, "monolith_end_to_end")
    bronze = ingest_monolith_bronze(spark, staged_feed(spark, sf_dir, CUSTOMERS), t)
    insert_values(spark, bronze, ["UUID", "Points"], [(int(k), p) for k, p in INLINE_ROWS])
    silver = read_layer(spark, build_monolith_silver(spark, t))
    if {FILE_NAME, INGESTED_AT} & set(silver.columns):
        raise ValueError("silver keeps provenance columns")
    build_monolith_gold(spark, t)
    return read_monolith_gold(spark, t)


def q_layers_two_files(spark, sf_dir):
    """Two customers files side by side: a table of each layer for both."""
    t = _target(spark, "layers_two_files")
    tables = run_layers(spark, _parts(spark, sf_dir), t)
    even, odd = (read_layer(spark, tables[f"customers_{p}_gold"]).withColumn("part", F.lit(p)) for p in ("even", "odd"))
    return even.unionByName(odd).select("part", *GOLD_STABLE)


def q_layers_end_to_end(spark, sf_dir):
    t = _target(spark, "layers_end_to_end")
    tables = run_layers(
        spark,
        {"customers.csv": staged_feed(spark, sf_dir, CUSTOMERS), "products.csv": staged_feed(spark, sf_dir, PRODUCTS)},
        t,
    )
    return read_layer(spark, tables["customers_gold"]).select(*GOLD_STABLE)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

# and K9 read listings or the catalog, no table: they are tested as helpers. R ids
# are operations that the survey's list doesn't have (README, "Safe loads").
INVENTORY: dict[str, str] = {
    "scan_csv_schema": "S1",
    "scan_csv_infer_dir": "S2",
    "scan_csv_preview": "S3",
    "scan_file_provenance": "S5 S6 X7",
    "scan_layer_table": "S7 S8 S9 S10",
    "filter_by_source_file": "F1",
    "sink_overwrite": "K1",
    "sink_overwrite_schema": "K2",
    "sink_append_evolve": "K3",
    "sink_ctas_replace": "K4",
    "sink_insert_partial": "K5",
    "sink_insert_values": "S11 D8",
    "temp_view": "K6",
    "project_star_plus": "P1",
    "project_rename": "P2",
    "project_with_columns": "P3",
    "project_chained": "P4",
    "silver_customers": "P5 C2",
    "project_drop": "P6",
    "stamp_ingestion": "P7 X6",
    "case_insensitive_columns": "P8",
    "predicate_range": "F2",
    "predicate_is_null": "F3",
    "case_when": "F4",
    "band_half_open": "B1",
    "band_closed": "B2",
    "band_unguarded": "B3",
    "first_name": "N1 X3",
    "first_name_no_guard": "N2",
    "first_token_upper": "N3",
    "first_name_udf": "U1",
    "try_cast_int": "X1",
    "cast_decimal": "X2",
    "split_get_item": "X4 X5",
    "agg_per_key": "A1",
    "gold_by_key_and_band": "A2 A7 C4",
    "group_by_all": "A3",
    "count_column_nulls": "A5",
    "agg_all_null_group": "A6",
    "distinct_values": "A8",
    "validate_join_left": "J1 A4 C7",
    "window_totals": "W1 A9",
    "gold_window": "W2 O2 C6",
    "window_each_aggregate": "W3 P9",
    "sort_desc_alias": "O1",
    "bronze_customers": "C1",
    "bronze_with_rejects": "R1",
    "bronze_products": "C1",
    "silver_products": "C3",
    "silver_monolith": "C5",
    "rebuild_after_insert": "C8",
    "batch_repeated": "R2",
    "gold_by_batches": "R3",
    "sink_stable_name": "R4",
    "mixed_folder": "R5",
    "scan_infer_once": "R6",
    "layers_resumed": "R7",
    "gold_many_names": "R8",
    "monolith_end_to_end": "S2 C5 C6 P6",
    "layers_two_files": "K7",
    "layers_end_to_end": "C9",
}
