"""Table sinks: each test writes into its own database at a fresh folder."""

from __future__ import annotations

import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from core_helpers import rows, same_rows
from tierline.operators.sinks import (
    append_evolving,
    describe_table,
    ensure_database,
    insert_by_name,
    insert_values,
    overwrite_table,
    register_view,
    remove_old_versions,
    replace_table_as,
    save_table,
    show_tables,
)


@pytest.fixture()
def db(spark):
    name = f"tl_test_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, tempfile.mkdtemp(prefix="tierline-test-db-"))
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_overwrite_twice_is_stable(spark, edge, db):
    t = f"{db}.tab_customers_bronze"
    overwrite_table(edge, t)
    overwrite_table(edge, t)
    assert same_rows(spark.table(t), edge)


def test_overwrite_replaces_schema(spark, edge, db):
    t = f"{db}.tab_x_silver"
    save_table(edge, t, "overwrite")
    narrower = edge.select("UUID", F.col("Points").try_cast("int").alias("points"))
    save_table(narrower, t, "overwrite")
    assert spark.table(t).columns == ["UUID", "points"]
    assert same_rows(spark.table(t), narrower)


def test_append_evolving_adds_columns(spark, edge, db):
    t = f"{db}.tab_customers_bronze"
    overwrite_table(edge, t)
    late = spark.createDataFrame([("u9", "250", "late")], "UUID string, Points string, arrival string")
    append_evolving(late, t)
    table = spark.table(t)
    assert table.columns == ["UUID", "Name", "Points", "arrival"]
    assert table.count() == edge.count() + 1
    assert table.where("arrival IS NULL").count() == edge.count()  # old rows read NULL
    assert rows(table.where("arrival = 'late'"), "UUID", "Name", "Points") == [("u9", None, "250")]


def test_append_evolving_refuses_type_change(spark, edge, db):
    t = f"{db}.tab_customers_bronze"
    overwrite_table(edge, t)
    with pytest.raises(TypeError):
        append_evolving(spark.createDataFrame([(1,)], "Points int"), t)


def test_append_evolving_creates_missing_table(spark, edge, db):
    t = f"{db}.tab_new_bronze"
    append_evolving(edge, t)
    assert same_rows(spark.table(t), edge)


def test_insert_partial_fills_null(spark, edge, db):
    t = f"{db}.tab_monolith_bronze"
    overwrite_table(edge, t)
    insert_values(spark, t, ["UUID", "Points"], [("a1", "250"), ("a2", "250"), ("a1", "250")])
    added = spark.table(t).where("Points = '250'")
    assert rows(added, "UUID", "Name") == [("a1", None), ("a1", None), ("a2", None)]


def test_insert_unknown_column_raises(spark, edge, db):
    t = f"{db}.tab_monolith_bronze"
    overwrite_table(edge, t)
    with pytest.raises(ValueError):
        insert_by_name(spark.createDataFrame([("x",)], "nope string"), t)
    with pytest.raises(ValueError):
        insert_values(spark, t, ["UUID", "nope"], [("a", "b")])


def test_replace_table_as_from_sql_and_frame(spark, edge, db):
    t = f"{db}.tab_customers_gold"
    register_view(edge, "tl_edge_v")
    replace_table_as(spark, "SELECT UUID, COUNT(UUID) AS n FROM tl_edge_v GROUP BY UUID", t)
    assert spark.table(t).count() == 7
    replace_table_as(spark, edge.select("UUID"), t)  # replace with another schema
    assert spark.table(t).columns == ["UUID"] and spark.table(t).count() == 11


def test_save_table_rejects_unknown_mode(edge):
    with pytest.raises(ValueError):
        save_table(edge, "x", "merge")


def test_describe_and_show(spark, edge, db):
    t = f"{db}.tab_customers_bronze"
    overwrite_table(edge, t)
    desc = {r["col_name"]: r["data_type"] for r in describe_table(spark, t).collect()}
    assert desc == {"UUID": "string", "Name": "string", "Points": "string"}
    assert [r["tableName"] for r in show_tables(spark, db, include_temporary=False).collect()] == ["tab_customers_bronze"]
    register_view(edge, "tl_listed_v")
    assert "tl_listed_v" in [r["tableName"] for r in show_tables(spark, db).collect()]


def test_view_resolves_case_insensitively(spark, edge):
    register_view(edge, "tl_ci_v")
    out = spark.sql("SELECT uuid, points FROM tl_ci_v")
    assert out.columns == ["uuid", "points"]  # output takes the query's spelling
    assert out.count() == 11


def test_replace_may_read_its_own_target(spark, edge, db):
    """The new rows are written aside first, so a query may read the table it
    replaces (a plain parquet overwrite refuses that)."""
    t = f"{db}.tab_customers_bronze"
    overwrite_table(edge, t)
    replace_table_as(spark, spark.table(t).where("UUID IS NOT NULL"), t)
    assert spark.table(t).count() == edge.where("UUID IS NOT NULL").count()
    assert [r["tableName"] for r in show_tables(spark, db, include_temporary=False).collect()] == ["tab_customers_bronze"]


def test_failed_overwrite_keeps_the_old_table(spark, edge, db):
    """A write job that fails leaves the previous table whole."""
    t = f"{db}.tab_customers_bronze"
    overwrite_table(edge, t)
    bad = edge.select(F.col("UUID"), F.assert_true(F.lit(False), "boom").alias("x"))
    with pytest.raises(Exception):
        overwrite_table(bad, t)
    assert same_rows(spark.table(t), edge)


def _location(spark, table):
    return spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]


def test_same_columns_are_replaced_without_absence(spark, edge, db, monkeypatch):
    """The table keeps its catalog entry: one change of its location, and no data moves."""
    t = f"{db}.tab_customers_bronze"
    overwrite_table(edge, t)
    first, said = _location(spark, t), []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (said.append(q), sql(self, q, *a, **k))[1])
    overwrite_table(edge.union(edge), t)
    monkeypatch.undo()
    assert [q.split()[0:2] for q in said] == [["ALTER", "TABLE"]] and "SET LOCATION" in said[0]
    assert spark.table(t).count() == 2 * edge.count() and _location(spark, t) != first
    assert spark.read.parquet(first).count() == edge.count()  # the old version stays for its readers


def test_two_writers_use_separate_folders(spark, edge, db):
    from concurrent.futures import ThreadPoolExecutor

    t = f"{db}.tab_customers_bronze"
    overwrite_table(edge, t)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda n: overwrite_table(edge.limit(n), t), (3, 7)))
    assert spark.table(t).count() in (3, 7)


def test_old_versions_are_removed_on_demand(spark, edge, db):
    t = f"{db}.tab_customers_bronze"
    for _ in range(3):
        overwrite_table(edge, t)
    assert remove_old_versions(spark, t) == []  # too young
    assert len(remove_old_versions(spark, t, older_than_hours=0)) == 2
    assert same_rows(spark.table(t), edge)


def test_a_managed_table_is_replaced_too(spark, edge, db):
    t = f"{db}.tab_old"
    edge.write.saveAsTable(t)
    overwrite_table(edge.select("UUID"), t)
    overwrite_table(edge, t)
    assert same_rows(spark.table(t), edge)


def testname_parts():
    from tierline.operators.sinks import name_parts

    assert name_parts("`spark_catalog`.`db`.`t.x`") == ["spark_catalog", "db", "t.x"]
    assert name_parts("db.t") == ["db", "t"]


def test_three_part_names(spark, edge, db):
    """Catalog-qualified layer names (K7): overwrite swap and append both work."""
    from tierline.specs import layer_table

    t = layer_table("customers", "bronze", db, "spark_catalog")
    overwrite_table(edge, t)
    overwrite_table(edge.union(edge), t)  # another version
    assert spark.table(t).count() == 2 * edge.count()
    append_evolving(spark.createDataFrame([("z", "new")], "UUID string, extra string"), t)
    assert spark.table(t).columns == ["UUID", "Name", "Points", "extra"]


def test_partitioned_overwrite_swap(spark, edge, db):
    """A partitioned table survives the write-aside-and-rename replace, and its
    partitions still prune at read time."""
    from tierline.operators.silver import silver_customers

    t = f"{db}.tab_customers_silver"
    silver = silver_customers(edge, with_stamp=False)
    overwrite_table(silver, t, partition_by=["band"])
    overwrite_table(silver, t, partition_by=["band"])
    assert same_rows(spark.table(t).select(*silver.columns), silver)
    pruned = spark.table(t).where("band = 'invalid'")
    assert pruned.count() == silver.where("band = 'invalid'").count()
    assert "PartitionFilters: [isnotnull(band" in pruned._jdf.queryExecution().executedPlan().toString()
