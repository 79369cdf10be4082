"""Rejects, repeatable batches, stable names, mixed folders and resumed flows."""

from __future__ import annotations

import uuid
from pathlib import Path

import pytest
from core_helpers import SF_SMALL, rows, same_rows

from tierline.operators import batches, gold, rejects
from tierline.operators.silver import silver_monolith
from tierline.operators.sinks import overwrite_table, remove_old_versions
from tierline.plans import flow
from tierline.plans.flow import Target, load_batch, monolith_tables
from tierline.sources.derived import late_rows, participation
from tierline.specs import CUSTOMERS


@pytest.fixture
def target(spark, tmp_path):
    db = f"tl_safe_{uuid.uuid4().hex[:8]}"
    yield Target(database=db, location=str(tmp_path / "db")).ensure(spark)
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


FEED = "UUID;Name;Points\nu1;Ana x;10\nu2;Bob;20;surplus\nu3\nu4;;\n"


def feed(tmp_path, text=FEED, name="customers.csv"):
    at = tmp_path / f"in-{uuid.uuid4().hex[:6]}"
    at.mkdir()
    (at / name).write_text(text)
    return str(at)


# -- rejects ---------------------------------------------------------------------

def test_rejects_are_split_and_counted(spark, target, tmp_path):
    loaded = flow.ingest_bronze_checked(spark, feed(tmp_path), "customers.csv", target)
    assert (loaded.n_rows, loaded.n_rejects) == (2, 2)
    assert rows(spark.table(loaded.table), "UUID", "Name", "Points") == [("u1", "Ana x", "10"), ("u4", None, None)]
    found = spark.table(loaded.rejects)
    assert found.columns == ["file_name", "ingested_at", "line"]
    assert rows(found, "file_name", "line") == [("customers.csv", "u2;Bob;20;surplus"), ("customers.csv", "u3")]
    again = flow.ingest_bronze_checked(spark, feed(tmp_path, "UUID;Name;Points\nu9;Z;1\n"), "customers.csv", target)
    assert (again.n_rows, again.n_rejects) == (1, 0)
    assert spark.table(again.rejects).count() == 0 and spark.table(again.table).count() == 1


def test_rejects_scan_the_feed_once(spark, target, tmp_path, monkeypatch):
    plans = []
    real = rejects.write_version
    monkeypatch.setattr(rejects, "write_version", lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *a)))
    flow.ingest_bronze_checked(spark, feed(tmp_path), "customers.csv", target)
    assert len(plans) == 1 and plans[0].count("FileScan csv") == 1


def test_too_many_rejects_publish_nothing(spark, target, tmp_path):
    loaded = flow.ingest_bronze_checked(spark, feed(tmp_path), "customers.csv", target, max_share=0.5)
    before = rows(spark.table(loaded.table), "UUID")
    with pytest.raises(rejects.TooManyRejects, match="3 of 4"):
        flow.ingest_bronze_checked(spark, feed(tmp_path, "h\na\nb\nc;d;e\nf\n"), "customers.csv", target, max_share=0.5)
    assert rows(spark.table(loaded.table), "UUID") == before and spark.table(loaded.rejects).count() == 2


def test_rejects_of_an_empty_feed_and_their_versions(spark, target, tmp_path):
    loaded = flow.ingest_bronze_checked(spark, feed(tmp_path, "UUID;Name;Points\n"), "customers.csv", target, max_share=0.0)
    assert (loaded.n_rows, loaded.n_rejects) == (0, 0)
    assert spark.table(loaded.table).count() == spark.table(loaded.rejects).count() == 0
    first = flow.ingest_bronze_checked(spark, feed(tmp_path), "customers.csv", target)
    overwrite_table(spark.table(first.table).limit(1), first.table)  # the rejects still read the first load's folder
    assert len(remove_old_versions(spark, first.table, older_than_hours=-1)) == 1
    assert spark.table(first.rejects).count() == 2 and spark.table(first.table).count() == 1


# -- batches -----------------------------------------------------------------------

def test_a_batch_is_there_once(spark, target):
    table = target.table("monolith", "bronze")
    df = spark.createDataFrame([("a", "n", "1"), ("b", None, None)], "UUID string, Name string, Points string")
    batches.put_batch(df, table, "day 1/it's")
    batches.put_batch(df.select("points", "uuid"), table, "2")
    batches.put_batch(df.select("points", "uuid").limit(1), table, "2")
    assert batches.batches_of(spark, table) == ["2", "day 1/it's"]
    assert batches.read_batch(spark, table, "day 1/it's").count() == 2
    assert rows(batches.read_batch(spark, table, "2"), "UUID", "Name", "Points") == [("a", None, "1")]
    batches.put_batch(df.where("false"), table, "2")
    assert spark.table(table).count() == 2
    with pytest.raises(ValueError, match="other"):
        batches.put_batch(df.withColumnRenamed("Name", "other"), table, "3")


def test_a_failed_load_is_repeated(spark, target, monkeypatch):
    first, late = participation(spark, SF_SMALL), late_rows(spark, SF_SMALL)
    load_batch(spark, first, target, "first")
    real = flow.put_batch

    def fails(df, table, batch, fmt):
        if table.endswith("partials`"):
            raise OSError("lost")
        return real(df, table, batch, fmt)

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(flow, "put_batch", fails)
        load_batch(spark, late, target, "late")
    got = spark.table(load_batch(spark, late, target, "late"))
    everything = first.unionByName(late, allowMissingColumns=True)
    assert spark.table(monolith_tables(target)["bronze"]).count() == everything.count()
    assert same_rows(got, gold.window_totals(silver_monolith(everything)))


def test_late_rows_read_no_earlier_bronze(spark, target, monkeypatch):
    load_batch(spark, participation(spark, SF_SMALL), target, "first")
    plans = []
    real = batches.write_version
    monkeypatch.setattr(batches, "write_version", lambda df, *a: (plans.append(df), real(df, *a)))
    load_batch(spark, late_rows(spark, SF_SMALL), target, "late")
    _, silver, parts = plans
    for df, layer in ((silver, "bronze"), (parts, "silver")):
        files = df.inputFiles()
        of_first = set(batches.read_batch(spark, monolith_tables(target)[layer], "first").inputFiles())
        assert files and not of_first & set(files)


def test_partials_of_parts_give_the_totals(spark, edge):
    silver = silver_monolith(edge)
    cut = silver.randomSplit([1.0, 1.0, 1.0], seed=4)
    parts = None
    for c in cut:
        parts = gold.partials(c) if parts is None else parts.unionByName(gold.partials(c))
    assert same_rows(gold.window_totals_of(parts), gold.window_totals(silver))


# -- stable names --------------------------------------------------------------------

def test_name_is_never_absent_while_columns_change(spark, target):
    import threading

    from tierline.operators.versions import publish

    name = target.table("customers", "gold")
    publish(spark.createDataFrame([(1,)], "a int"), name)
    seen, failed, stop = set(), [], threading.Event()

    def reads():
        while not stop.is_set():
            try:
                seen.add(tuple(spark.table(name).columns))
            except Exception as e:
                failed.append(str(e)[:600])

    reader = threading.Thread(target=reads)
    reader.start()
    for i in range(6):
        publish(spark.createDataFrame([(i, "x")], f"a int, b{i % 2} string"), name)
    stop.set()
    reader.join()
    assert not failed and seen <= {("a",), ("a", "b0"), ("a", "b1")}
    assert spark.table(name).columns == ["a", "b1"]


def test_one_of_two_writers_gets_an_error(spark, target):
    from tierline.operators import versions as V

    name = target.table("customers", "silver")
    first = V.publish(spark.range(3).toDF("a"), name, based_on=None)
    with pytest.raises(V.LostUpdate):
        V.publish(spark.range(9).toDF("a"), name, based_on=None)  # another writer of the first version
    mine = spark.table(name).selectExpr("a", "a * 2 AS b")
    V.publish(spark.table(name).where("a > 0"), name, based_on=first)
    with pytest.raises(V.LostUpdate):
        V.publish(mine, name, based_on=first)
    assert rows(spark.table(name), "a") == [(1,), (2,)]


def test_both_writers_have_passed_the_first_look(spark, target, monkeypatch):
    """The small file decides where both still saw the old version."""
    from tierline.operators import versions as V

    name = target.table("customers", "silver")
    first = V.publish(spark.range(3).toDF("a"), name, based_on=None)
    V.publish(spark.range(4).toDF("a"), name, based_on=first)
    with monkeypatch.context() as m:
        m.setattr(V, "current_version", lambda *_: first)
        with pytest.raises(V.LostUpdate):
            V.publish(spark.range(5).toDF("a"), name, based_on=first)
    assert spark.table(name).count() == 4


def test_a_claim_of_a_dead_writer_is_settled(spark, target, monkeypatch):
    from tierline.operators import versions as V

    name = target.table("customers", "silver")
    first = V.publish(spark.range(1).toDF("a"), name, based_on=None)
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(V, "_show", lambda *_: (_ for _ in ()).throw(OSError("died")))
        V.publish(spark.range(2).toDF("a"), name, based_on=first)
    assert spark.table(name).count() == 1
    version = V.settle(spark, name)
    assert spark.table(name).count() == 2 and V.settle(spark, name) == version
    V.publish(spark.range(3).toDF("a"), name, based_on=version)
    assert spark.table(name).count() == 3


def test_inserts_and_old_versions(spark, target, monkeypatch):
    from tierline.operators import versions as V

    name = target.table("customers", "silver")
    with pytest.raises(ValueError, match="no version"):
        V.insert_current(spark.range(1).toDF("a"), name)
    V.publish(spark.range(2).selectExpr("id AS a", "'x' AS b"), name)
    V.insert_current(spark.range(5, 6).toDF("a"), name)
    assert rows(spark.table(name), "a", "b") == [(0, "x"), (1, "x"), (5, None)]
    V.publish(spark.table(name).drop("b"), name)  # reads the version that it replaces
    assert len(V.drop_old(spark, name, older_than_hours=-1)) == 1
    assert rows(spark.table(name), "a") == [(0,), (1,), (5,)]
    overwrite_table(spark.range(1).toDF("a"), target.table("customers", "gold"))
    with pytest.raises(ValueError, match="table of its own"):
        V.current_version(spark, target.table("customers", "gold"))
    told = iter([V.current_version(spark, name), "another"])
    monkeypatch.setattr(V, "current_version", lambda *_: next(told))
    with pytest.raises(V.LostUpdate):
        V.insert_current(spark.range(1).toDF("a"), name)


# -- mixed folders -------------------------------------------------------------------

def test_mixed_folder(spark, target, tmp_path):
    at = tmp_path / "mixed"
    at.mkdir()
    (at / "customers_jan.csv").write_text('UUID;Name;Points\nu1;"a;b";10\n\nu2;x;1;9\n')
    (at / "Customers_feb.csv").write_text("UUID;Name;Points\nu3; y ;\n")
    (at / "products.csv").write_text("1;ChatMessage;Mensagem\np1;hi;there\np2;only\n")
    (at / "notes.csv").write_text("h\nfree text; here\n")
    tables = flow.ingest_mixed(spark, str(at), target)
    assert rows(spark.table(tables["customers"]), "UUID", "Name", "Points") == [("u1", "a;b", "10"), ("u3", " y ", None)]
    assert spark.table(tables["products"]).columns == ["1", "ChatMessage", "Mensagem_do_chat_da_Twitch", "file_name", "ingested_at"]
    assert rows(spark.table(tables["products"]), "1", "file_name") == [("p1", "products.csv")]
    assert rows(spark.table(tables["rejects"]), "file_name", "line") == [
        ("customers_jan.csv", "u2;x;1;9"), ("notes.csv", "free text; here"), ("products.csv", "p2;only")]


def test_mixed_folder_is_scanned_once(spark, target, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    at = tmp_path / "one"
    at.mkdir()
    (at / "customers.csv").write_text("UUID;Name;Points\nu1;a;10\n")
    plans = []
    for kind in ("parquet", "save"):
        real = getattr(DataFrameWriter, kind)
        monkeypatch.setattr(DataFrameWriter, kind, lambda self, *a, f=real, **k: (plans.append(self._df._jdf.queryExecution().executedPlan().toString()), f(self, *a, **k))[1])
    tables = flow.ingest_mixed(spark, str(at), target)
    assert sum(p.count("FileScan csv") for p in plans) == 1
    assert spark.table(tables["products"]).count() == 0 and spark.table(tables["customers"]).count() == 1


# -- types from one scan -----------------------------------------------------------------

COLUMNS = {
    "small": ["1", "-2", "", "+3"],
    "large": ["1", "5000000000", "", "2"],
    "huge": ["12345678901234567890123", "1", "", "7"],
    "real": ["1", "2.5", "1e3", "NaN"],
    "day": ["2024-01-31", "", "2023-12-01", "2020-02-29"],
    "time": ["2024-01-31 10:00:00", "2024-01-31T10:00:01", "", "2024-01-31 10:00:00.5"],
    "both": ["2024-01-31", "2024-01-31 10:00:00", "", ""],
    "flag": ["true", "FALSE", "", "True"],
    "text": ["1", "x", "", "true"],
    "spaced": [" 1", "2 ", "", "3"],
    "none": ["", "", "", ""],
    "odd day": ["2024-13-01", "2024-01-01", "", ""],
}


def test_types_are_those_of_inference(spark, target, tmp_path):
    from tierline.operators.landing import land_inferred

    lines = [";".join(COLUMNS)] + [";".join(COLUMNS[c][i] for c in COLUMNS) for i in range(4)]
    at = feed(tmp_path, "\n".join(lines) + "\n")
    table = target.table("x", "bronze")
    types = land_inferred(spark, at, table, target.table("x_landed", "bronze"))
    want = spark.read.options(sep=";", header="true", inferSchema="true").csv(at)
    got = spark.table(table)
    assert got.columns == [*COLUMNS, "file_name", "ingested_at"]
    assert dict(got.dtypes) | {"file_name": 0, "ingested_at": 0} == dict(want.dtypes) | {"file_name": 0, "ingested_at": 0}
    assert same_rows(got.select(*want.columns), want)
    assert types["none"] == "string"
    again = land_inferred(spark, feed(tmp_path, "small\nx\n"), table, target.table("x_landed", "bronze"))
    assert again == {"small": "string"} and spark.table(table).count() == 1


def test_inference_scans_the_input_once(spark, target, tmp_path, monkeypatch):
    from tierline.operators import sinks
    from tierline.operators.landing import land_inferred

    plans = []
    real = sinks.write_version
    monkeypatch.setattr(sinks, "write_version", lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *a)))
    land_inferred(spark, feed(tmp_path, "a;b\n1;2\n"), target.table("y", "bronze"), target.table("y_landed", "bronze"))
    assert len(plans) == 1 and plans[0].count("FileScan csv") == 1 and "Exchange" not in plans[0]


# -- resumed flows -------------------------------------------------------------------------

def test_a_failed_flow_goes_on_where_it_failed(spark, target, tmp_path, monkeypatch):
    c, p = feed(tmp_path, "UUID;Name;Points\nu1;Ana;10\n"), feed(tmp_path, "1;ChatMessage;M\np1;a;b\n", "products.csv")
    feeds, ledger = {"customers.csv": c, "products.csv": p}, str(tmp_path / "ledger")
    made = []
    for step in ("ingest_bronze", "build_silver", "build_gold"):
        real = getattr(flow, step)
        monkeypatch.setattr(flow, step, lambda *a, f=real, s=step, **k: (made.append(s), f(*a, **k))[1])
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setitem(flow.__dict__, "silver_products", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        flow.run_layers(spark, feeds, target, parallel=False, ledger=ledger)
    assert made == ["ingest_bronze", "build_silver", "ingest_bronze", "build_silver"]
    made.clear()
    tables = flow.run_layers(spark, feeds, target, ledger=ledger)
    assert made == ["build_silver", "build_gold"] and spark.table(tables["customers_gold"]).count() == 1
    made.clear()
    assert flow.run_layers(spark, feeds, target, ledger=ledger) == tables and made == []
    Path(p, "products.csv").write_text("1;ChatMessage;M\np1;a;b\np2;c;d\n")  # new input: its branch only
    flow.run_layers(spark, feeds, target, ledger=ledger)
    assert made == ["ingest_bronze", "build_silver"] and spark.table(tables["products_silver"]).count() == 2
    made.clear()
    overwrite_table(spark.table(tables["customers_bronze"]), tables["customers_bronze"])  # someone else's write
    flow.run_layers(spark, feeds, target, ledger=ledger)
    assert made == ["ingest_bronze", "build_silver", "build_gold"]


def test_command_line(spark, target, tmp_path):
    from tierline.__main__ import main

    c = feed(tmp_path)
    loaded = main(["bronze", "--path", c, "--file", "customers.csv", "--schema", target.database, "--max-rejects", "0.6"])
    assert spark.table(loaded["rejects"]).count() == 2 == spark.table(loaded["bronze"]).count()
    with pytest.raises(rejects.TooManyRejects):
        main(["bronze", "--path", c, "--file", "customers.csv", "--schema", target.database, "--max-rejects", "0.1"])
    Path(c, "products.csv").write_text("1;ChatMessage;M\np1;a;b\n")
    assert set(main(["mixed", "--path", c, "--schema", target.database])) == {"customers", "products", "rejects"}
    flows = [main(["all", "--path", c, "--schema", target.database, "--ledger", str(tmp_path / "done")]) for _ in range(2)]
    assert flows[0] == flows[1] and len(list((tmp_path / "done").glob("*.json"))) == 5
