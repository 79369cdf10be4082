"""Feed readers on hand-written files, and the derived feeds."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from core_helpers import SF_SMALL, rows
from tierline.sources.derived import participation, product_feed, staged_feed
from tierline.sources.feeds import (
    file_inventory,
    malformed_rows,
    only_source_file,
    only_source_files,
    preview_feed,
    read_feed,
    read_feed_inferred,
)
from tierline.specs import CUSTOMERS, PRODUCTS, FeedSpec

# A products-style file: the first line is a header whose third name differs
# from the declared one, and every line has data shape.
PRODUCTS_TEXT = "1;ChatMessage;Message text here\n2;Redeem;first reward\n3;Presence;list signed\n4;Swap;cubes\n5;Streak;recurring list"
CUSTOMERS_TEXT = "UUID;Name;Points\nu1;Ana_Souza x;999\nu2; lead;abc\n;NoId;10\n"


def _folder(files: dict[str, str]) -> str:
    d = tempfile.mkdtemp(prefix="tierline-feed-")
    for name, text in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
            fh.write(text)
    return d


def test_schema_binds_by_position_and_header_is_skipped(spark):
    d = _folder({"products.csv": PRODUCTS_TEXT})
    df = read_feed(spark, os.path.join(d, "products.csv"), PRODUCTS)
    assert df.columns == ["1", "ChatMessage", "Mensagem_do_chat_da_Twitch", "file_name", "ingested_at"]
    assert rows(df, "1", "Mensagem_do_chat_da_Twitch")[0] == ("2", "first reward")
    assert df.count() == 4  # line 1 is consumed as the header
    assert {r["file_name"] for r in df.collect()} == {"products.csv"}


def test_header_off_keeps_first_line(spark):
    d = _folder({"products.csv": PRODUCTS_TEXT})
    spec = FeedSpec(name="products", schema=PRODUCTS.schema, header=False)
    assert read_feed(spark, d, spec).count() == 5


def test_provenance_with_modification_time(spark):
    d = _folder({"customers.csv": CUSTOMERS_TEXT})
    df = read_feed(spark, d, CUSTOMERS, with_modified=True)
    r = df.where("UUID = 'u1'").first()
    assert r["file_name"] == "customers.csv" and r["file_modified_at"] is not None
    assert r["ingested_at"] is not None
    assert rows(df, "UUID", "Name") == [(None, "NoId"), ("u1", "Ana_Souza x"), ("u2", " lead")]


def test_only_source_file_filters_at_scan(spark):
    d = _folder({"customers.csv": CUSTOMERS_TEXT, "customers_2.csv": CUSTOMERS_TEXT.replace("u1", "z1")})
    df = only_source_file(read_feed(spark, d, CUSTOMERS), "customers_2.csv")
    assert sorted(r["UUID"] or "" for r in df.collect()) == ["", "u2", "z1"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: [" in plan and "customers_2.csv" in plan.split("FileScan")[1]


def test_lines_with_other_field_counts_are_reported(spark):
    d = _folder({"customers.csv": CUSTOMERS_TEXT + "u8;Too;1;many\nu9;few\n"})
    found = {(r["file_name"], r["line"]) for r in malformed_rows(spark, d, CUSTOMERS).collect()}
    assert found == {("customers.csv", "u8;Too;1;many"), ("customers.csv", "u9;few")}


def test_rows_of_an_inventorys_files(spark):
    d = _folder({"customers.csv": CUSTOMERS_TEXT, "customers_2.csv": CUSTOMERS_TEXT.replace("u1", "z1")})
    files = file_inventory(spark, d).where("name LIKE '%2.csv'")
    df = only_source_files(read_feed(spark, d, CUSTOMERS), files)
    assert sorted(r["UUID"] or "" for r in df.collect()) == ["", "u2", "z1"]


def test_preview_and_inference(spark):
    d = _folder({"customers.csv": CUSTOMERS_TEXT})
    prev = preview_feed(spark, d)
    assert prev.columns == ["UUID", "Name", "Points"] and all(t == "string" for _, t in prev.dtypes)
    inferred = read_feed_inferred(spark, d)
    assert dict(inferred.dtypes)["Points"] == "string"  # 'abc' keeps it a string
    nums = _folder({"n.csv": "k;v\n1;2\n3;4\n"})
    assert dict(read_feed_inferred(spark, nums).dtypes) == {"k": "int", "v": "int", "file_name": "string",
                                                            "ingested_at": "timestamp"}


def test_file_inventory_prunes_content(spark):
    d = _folder({"customers.csv": CUSTOMERS_TEXT, "notes.txt": "x"})
    inv = file_inventory(spark, d, glob="*.csv")
    assert [r["name"] for r in inv.collect()] == ["customers.csv"]
    assert "content" not in inv._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_staged_feed_round_trip_and_reuse(spark):
    path = staged_feed(spark, SF_SMALL, CUSTOMERS)
    again = staged_feed(spark, SF_SMALL, CUSTOMERS)
    assert path == again
    back = read_feed(spark, path, CUSTOMERS).drop("file_name", "ingested_at")
    src = participation(spark, SF_SMALL)
    assert back.exceptAll(src).isEmpty() and src.exceptAll(back).isEmpty()  # blanks and NULLs survive
    assert back.where(F.col("Name").startswith(" ")).count() > 0


def test_derived_feeds_cover_edge_cases(spark):
    p = participation(spark, SF_SMALL)
    assert p.where("UUID IS NULL").count() > 0
    assert p.where("Points IS NULL").count() > 0 and p.where("Points = 'n/a'").count() > 0
    assert p.where("Points LIKE '%.5'").count() > 0 and p.where("Points = '2000'").count() > 0
    assert product_feed(spark, SF_SMALL).columns == ["1", "ChatMessage", "Mensagem_do_chat_da_Twitch"]


def test_mixed_folder_unites_feeds_by_position(spark):
    """Two feeds in one folder: the header of the largest file names the
    columns and rows of both files line up by position (why production loads
    read one feed per folder with a declared schema)."""
    big = CUSTOMERS_TEXT + "".join(f"u{i};Name{i} x;{i}\n" for i in range(50))
    d = _folder({"customers.csv": big, "products.csv": PRODUCTS_TEXT})
    df = read_feed_inferred(spark, d)
    assert df.columns[:3] == ["UUID", "Name", "Points"]
    mixed = {r["file_name"]: r for r in df.collect()}
    assert mixed["products.csv"]["Points"] in {"first reward", "list signed", "cubes", "recurring list"}
    assert dict(df.dtypes)["Points"] == "string"


def test_session_time_zone_is_the_callers(spark):
    from tierline.session import build_session

    same = build_session(time_zone="America/Sao_Paulo")  # returns the running session
    try:
        assert same.conf.get("spark.sql.session.timeZone") == "America/Sao_Paulo"
    finally:
        same.conf.unset("spark.sql.session.timeZone")


def test_without_a_configured_checkpoint_folder(tmp_path):
    """A session with no ``spark.checkpoint.dir`` (no defaults file): a local
    folder is chosen once, feeds are staged and published there, and the
    checkpointing validation report runs."""
    import subprocess
    import sys
    import textwrap

    from core_helpers import ROOT

    conf_dir = tmp_path / "conf"
    conf_dir.mkdir()
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        assert spark.conf.get("spark.checkpoint.dir", None) is None
        from tierline.session import path_exists, workspace_dir
        from tierline.sources.derived import staged_feed
        from tierline.operators.gold import validation_report
        from tierline.operators.silver import silver_monolith
        from tierline.sources.derived import participation
        from tierline.specs import PRODUCTS
        ws = workspace_dir(spark)
        assert workspace_dir(spark) == ws and spark.sparkContext.getCheckpointDir()
        path = staged_feed(spark, {SF_SMALL!r}, PRODUCTS)
        assert path.startswith(ws) and path_exists(spark, path + "/_SUCCESS")
        assert staged_feed(spark, {SF_SMALL!r}, PRODUCTS) == path
        assert validation_report(silver_monolith(participation(spark, {SF_SMALL!r}))).count() > 0
        print("FALLBACK-OK")
    """)
    env = {**__import__("os").environ, "SPARK_CONF_DIR": str(conf_dir)}
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600, env=env)
    assert "FALLBACK-OK" in out.stdout, out.stdout[-2000:] + out.stderr[-4000:]
