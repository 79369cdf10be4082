"""Spec selection, table naming, the ordered flows and the time zone."""

from __future__ import annotations

import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from core_helpers import SF_SMALL, same_rows
from tierline.operators.gold import window_totals
from tierline.operators.silver import silver_monolith
from tierline.plans.flow import Target, build_gold, monolith_tables, rebuild_after_insert, run_layers
from tierline.operators.sinks import overwrite_table
from tierline.sources.derived import late_rows, participation, staged_feed
from tierline.specs import CUSTOMERS, PRODUCTS, dataset_name, layer_table, spec_for


def test_spec_for_and_naming():
    assert spec_for("customers.csv") is CUSTOMERS
    assert spec_for("Products.CSV") is PRODUCTS
    with pytest.raises(ValueError):
        spec_for("orders.csv")
    assert dataset_name("Customers.csv") == "customers"
    assert layer_table("customers.csv", "gold", "analytics", "main") == "`main`.`analytics`.`tab_customers_gold`"
    with pytest.raises(ValueError):
        layer_table("customers", "platinum")


@pytest.fixture()
def target(spark):
    t = Target(database=f"tl_flow_{uuid.uuid4().hex[:8]}", location=tempfile.mkdtemp(prefix="tierline-flow-"))
    yield t.ensure(spark)
    spark.sql(f"DROP DATABASE IF EXISTS {t.database} CASCADE")


def test_run_layers_in_order(spark, target):
    feeds = {"customers.csv": staged_feed(spark, SF_SMALL, CUSTOMERS),
             "products.csv": staged_feed(spark, SF_SMALL, PRODUCTS)}
    out = run_layers(spark, feeds, target)
    assert set(out) == {"customers_bronze", "products_bronze", "customers_silver", "products_silver", "customers_gold"}
    names = sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES IN {target.database}").where("NOT isTemporary").collect())
    assert names == ["tab_customers_bronze", "tab_customers_gold", "tab_customers_silver",
                     "tab_products_bronze", "tab_products_silver"]
    gold = spark.table(out["customers_gold"])
    assert gold.columns[-1] == "ingested_at"
    assert gold.agg(F.sum("participations")).first()[0] == participation(spark, SF_SMALL).where("UUID IS NOT NULL").count()
    assert spark.table(out["products_silver"]).columns == ["item_code", "message_kind", "message_text", "ingested_at"]


def test_rebuild_after_insert_moves_totals(spark, target):
    feed = participation(spark, SF_SMALL)
    overwrite_table(feed, monolith_tables(target)["bronze"])
    before = window_totals(silver_monolith(feed)).where("member_id IS NOT NULL")
    late = late_rows(spark, SF_SMALL)
    gold = spark.table(rebuild_after_insert(spark, late, target)).where("member_id IS NOT NULL")
    b = {(r["member_id"], r["band"]): r for r in before.collect()}
    g = {r["member_id"]: r for r in gold.collect()}
    for (key, _band), r in b.items():
        assert g[key]["participations"] == r["participations"] + 1
        assert g[key]["total_points"] == (r["total_points"] or 0) + 250
    # the late rows land in the lowest band, so keys may gain a band row
    assert gold.where("band = 'below_1000'").select("member_id").distinct().count() == late.count()


def test_library_leaves_session_time_zone_alone(spark, edge):
    tz = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        silver_monolith(edge).count()
        assert spark.conf.get("spark.sql.session.timeZone") == "America/Sao_Paulo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)


def test_gold_table_equals_frame(spark, target):
    feed = participation(spark, SF_SMALL)
    overwrite_table(feed, monolith_tables(target)["bronze"])
    from tierline.plans.flow import build_monolith_gold, build_monolith_silver

    build_monolith_silver(spark, target)
    table = spark.table(build_monolith_gold(spark, target))
    assert same_rows(table, window_totals(silver_monolith(feed)))


def test_command_line_steps(spark):
    from tierline.__main__ import main

    from test_sources import CUSTOMERS_TEXT, PRODUCTS_TEXT, _folder

    d = _folder({"customers.csv": CUSTOMERS_TEXT, "products.csv": PRODUCTS_TEXT})
    db = f"tl_cli_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tempfile.mkdtemp(prefix='tierline-cli-')}'")
    try:
        assert main(["bronze", "--path", d, "--file", "customers.csv", "--schema", db]) == {
            "bronze": f"`{db}`.`tab_customers_bronze`"}
        main(["silver", "--file", "customers", "--schema", db])
        gold = spark.table(main(["gold", "--file", "customers.csv", "--schema", db])["gold"])
        assert gold.count() == 3  # u1/below, u2/invalid, NULL/below
        out = main(["all", "--path", d, "--schema", db])
        assert spark.table(out["products_silver"]).count() == 4
        with pytest.raises(SystemExit):
            main(["bronze", "--schema", db])
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_a_table_of_each_layer_for_every_file(spark, target):
    """Two customers files of one schema: neither replaces the other."""
    from test_sources import CUSTOMERS_TEXT, _folder

    d = _folder({"customers_jan.csv": CUSTOMERS_TEXT, "customers_feb.csv": CUSTOMERS_TEXT.replace("u1", "z1")})
    out = run_layers(spark, {f: f"{d}/{f}" for f in ("customers_jan.csv", "customers_feb.csv")}, target)
    assert {r.UUID for r in spark.table(out["customers_jan_bronze"]).collect()} == {"u1", "u2", None}
    assert {r.UUID for r in spark.table(out["customers_feb_bronze"]).collect()} == {"z1", "u2", None}
    assert {r.member_id for r in spark.table(out["customers_feb_gold"]).collect()} == {"z1", "u2", None}
    assert len(out) == 6
    with pytest.raises(ValueError):
        build_gold(spark, target, "products.csv")


def test_precision_reaches_gold(spark, target):
    from test_sources import _folder

    d = _folder({"customers.csv": "UUID;Name;Points\nu1;Ana x;2147483647\n"})
    run = lambda **k: run_layers(spark, {"customers.csv": f"{d}/customers.csv"}, target, **k)
    if spark.conf.get("spark.sql.ansi.enabled") == "true":
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
            run()
    assert str(spark.table(run(precision=12)["customers_gold"]).first().avg_points) == "2147483647.00"


def test_monolith_command(spark):
    from tierline.__main__ import main

    from test_sources import CUSTOMERS_TEXT, _folder

    db = f"tl_mono_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tempfile.mkdtemp(prefix='tierline-mono-')}'")
    try:
        out = main(["monolith", "--path", _folder({"customers.csv": CUSTOMERS_TEXT}), "--schema", db])
        assert spark.table(out["bronze"]).columns == ["UUID", "Name", "Points", "file_name", "ingested_at"]
        assert not {"file_name", "ingested_at"} & set(spark.table(out["silver"]).columns)
        assert spark.table(out["gold"]).count() == 3
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_initial_partitions_are_the_callers(spark):
    from tierline.session import build_session

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert build_session(initial_partitions=64).conf.get(key) == "64"
    finally:
        spark.conf.unset(key)
