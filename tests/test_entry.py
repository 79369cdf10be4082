"""The driver contract, and every registered query against its DuckDB SQL."""

from __future__ import annotations

import sys

import pytest

from core_helpers import ROOT, SF_SMALL

sys.path.insert(0, str(ROOT / "scripts"))
import __spark_entry__ as E  # noqa: E402

SURVEY_KEYS = {
    "scan_csv_schema", "scan_csv_infer_dir", "scan_csv_preview", "scan_file_provenance",
    "scan_layer_table", "sink_overwrite", "sink_overwrite_schema", "sink_append_evolve", "sink_ctas_replace",
    "sink_insert_partial", "sink_insert_values", "temp_view", "project_star_plus", "project_rename",
    "project_with_columns", "project_chained", "silver_customers", "project_drop", "stamp_ingestion",
    "case_insensitive_columns", "filter_by_source_file", "predicate_range", "predicate_is_null", "case_when",
    "band_half_open", "band_closed", "band_unguarded", "first_name", "first_name_no_guard", "first_token_upper",
    "try_cast_int", "cast_decimal", "split_get_item", "agg_per_key", "gold_by_key_and_band", "group_by_all",
    "count_column_nulls", "agg_all_null_group", "distinct_values", "validate_join_left", "window_totals",
    "gold_window", "window_each_aggregate", "sort_desc_alias", "first_name_udf", "bronze_customers",
    "bronze_products", "silver_products", "silver_monolith", "rebuild_after_insert", "monolith_end_to_end",
    "layers_two_files", "layers_end_to_end",
    # operations beside the survey's keys
    "bronze_with_rejects", "batch_repeated", "gold_by_batches", "sink_stable_name", "mixed_folder", "scan_infer_once", "layers_resumed", "gold_many_names",
}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["member_id", "first_name", "participations", "total_points", "avg_points",
                          "min_points", "max_points", "band"]
    assert df.count() > 0


def test_results_of_two_calls_stay_readable(spark):
    one, two = (E.queries()["sink_overwrite"](spark, SF_SMALL) for _ in range(2))
    assert one.count() == two.count() > 0


def test_a_missing_library_leaves_the_other_queries(tmp_path):
    """Without a library that only the training-text queries need, the entry still gives the others."""
    import subprocess

    code = (
        "import sys, warnings\n"
        "sys.modules['xxhash'] = sys.modules['tokenizers'] = None\n"
        f"sys.path.insert(0, {str(ROOT)!r})\n"
        "warnings.simplefilter('ignore')\n"
        "import __spark_entry__ as E\n"
        "print(len(E.queries()), len(E.oracle_sql()))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, timeout=120)
    assert out.stdout.split() == [str(len(SURVEY_KEYS))] * 2, out.stderr[-500:]


def test_registry_covers_inventory():
    from tierline.plans.queries import INVENTORY

    extra = set() if E._llm is None else {*E._llm.QUERIES, "pipeline"}
    assert set(E.queries()) == SURVEY_KEYS | extra
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(INVENTORY) == SURVEY_KEYS
    ids = {i for v in INVENTORY.values() for i in v.split()}
    # spec selection, session time zone, and helpers that read listings only: unit tests
    unit_only = {"S12", "C10", "S4", "K8", "K9"}
    expected = {f"{p}{n}" for p, n in [("S", i) for i in range(1, 12)] + [("K", i) for i in range(1, 10)]
                + [("P", i) for i in range(1, 10)] + [("F", i) for i in range(1, 5)] + [("B", i) for i in range(1, 4)]
                + [("N", i) for i in range(1, 4)] + [("X", i) for i in range(1, 8)] + [("A", i) for i in range(1, 10)]
                + [("W", i) for i in range(1, 4)] + [("O", i) for i in range(1, 3)] + [("C", i) for i in range(1, 11)]}
    expected |= {"J1", "U1"}
    assert expected - unit_only <= ids, sorted(expected - unit_only - ids)


#: The function or method that does the work of an inventory id.
DOES = {
    "S1": "feeds.read_feed", "S2": "feeds.read_feed_inferred", "S3": "feeds.preview_feed", "S5": "feeds.file_inventory",
    "S7": "feeds.read_layer", "S11": "sinks.insert_values", "F1": "feeds.only_source_files", "K1": "sinks.overwrite_table",
    "K2": "sinks.save_table", "K3": "sinks.append_evolving", "K4": "sinks.replace_table_as", "K5": "sinks.insert_by_name",
    "K6": "sinks.register_view", "K7": "flow.run_layers", "A1": "gold.per_key_totals", "A2": "gold.gold_by_key_and_band",
    "A8": "gold.distinct_values", "J1": "gold.validation_report", "W1": "gold.window_totals", "W3": "gold.with_key_totals",
    "O1": "gold.sort_desc", "C1": "flow.ingest_bronze", "C2": "silver.silver_customers", "C8": "flow.rebuild_after_insert",
    "C9": "flow.run_layers",
    # beside the survey's list
    "R1": "rejects.ingest_with_rejects", "R2": "batches.put_batch", "R3": "flow.load_batch", "R4": "versions.publish",
    "R5": "flow.ingest_mixed", "R6": "landing.land_inferred", "R7": "flow.run_layers", "R8": "gold.key_band_of_many_names",
}


@pytest.mark.parametrize("id_", sorted(DOES))
def test_claimed_operators_are_called(spark, monkeypatch, id_):
    """Every query that claims the id calls its operator."""
    import sys as modules

    from tierline.plans.queries import INVENTORY, QUERIES

    name = DOES[id_].partition(".")[2]
    real = next(getattr(m, name) for k, m in modules.modules.items() if k.startswith("tierline.") and k.endswith(DOES[id_].partition(".")[0]))
    calls = []

    def counted(*a, **k):
        calls.append(name)
        return real(*a, **k)

    for k, m in list(modules.modules.items()):
        if k.startswith("tierline") and getattr(m, name, None) is real:
            monkeypatch.setattr(m, name, counted)
    for query, ids in INVENTORY.items():
        if id_ in ids.split():
            calls.clear()
            QUERIES[query](spark, SF_SMALL)
            assert calls, f"{query} claims {id_} but doesn't call {name}"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from check_oracle import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SURVEY_KEYS))
def test_query_matches_oracle(spark, duck, name):
    from collections import Counter

    from check_oracle import norm

    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    from tierline.plans.queries import drop_databases

    if name != "first_name_udf":  # the one query that asks for the Python rule
        assert "EvalPython" not in plan, plan  # default paths stay in the JVM
    columns = sorted(df.columns)  # as the driver compares
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    assert sql is not None
    drop_databases(spark)
    rel = duck.sql(sql)
    assert sorted(rel.columns) == columns
    want = [tuple(r[rel.columns.index(c)] for c in columns) for r in rel.fetchall()]
    assert Counter(tuple(map(norm, r)) for r in got) == Counter(tuple(map(norm, r)) for r in want)
