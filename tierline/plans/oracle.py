"""DuckDB SQL for each registered query, over the same parquet tables.

Where the Spark side uses a rewritten plan (pre-aggregated windows, joined-back
totals), the SQL here states the definition over raw rows, so the comparison
checks the rewrite too.

Engine differences handled here (see SURVEY 5.3):

* DuckDB's ``TRY_CAST('12.5' AS INTEGER)`` rounds; Spark's gives NULL. A
  regex guard makes DuckDB accept integer literals only.
* ``SUM(int)`` is HUGEINT in DuckDB; cast to BIGINT.
* Spark casts a double to decimal half-up on its shortest decimal text;
  DuckDB rounds the binary value. The decimal average is therefore computed
  exactly from integer sum and count: ``round_half_up(100*s/c) / 100``.
"""

from __future__ import annotations

from tierline.functions.columns import BAND_LABELS, BAND_LABELS_PT, INVALID_LABEL, INVALID_LABEL_PT
from tierline.plans.queries import INLINE_ROWS


def dec_avg(s: str, c: str) -> str:
    """Half-up ``s / c`` at 2 decimals as DECIMAL(10,2); NULL when ``c`` is 0."""
    return (
        f"CASE WHEN ({c}) > 0 THEN CAST(CAST(sign({s}) * ((abs({s}) * 200 + ({c})) // (2 * ({c}))) "
        f"AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) END"
    )


POINTS_INT = "CASE WHEN regexp_full_match(trim(Points), '[+-]?[0-9]+') THEN TRY_CAST(Points AS INTEGER) END"
FIRST_UNGUARDED = "upper(split_part(split_part(Name, ' ', 1), '_', 1))"
FIRST_GUARDED = f"CASE WHEN length(Name) > 0 THEN {FIRST_UNGUARDED} END"
FIRST_TOKEN = "upper(split_part(Name, ' ', 1))"


def band_sql(p: str, closed_top: bool = False, guarded: bool = True,
             labels=BAND_LABELS, invalid: str = INVALID_LABEL) -> str:
    mid = f"{p} <= 2000" if closed_top else f"{p} < 2000"
    guard = f"WHEN {p} IS NULL THEN '{invalid}' " if guarded else ""
    return (
        f"CASE {guard}WHEN {p} < 1000 THEN '{labels[0]}' WHEN {mid} THEN '{labels[1]}' "
        f"ELSE '{labels[2]}' END"
    )


# The participation feed derived from events; the same rules as
# tierline.sources.derived.participation (every row kept, edge cases chosen
# by event id).
PARTICIPATION = """
participation AS (
  SELECT
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS UUID,
    CASE WHEN event_id % 53 = 0 THEN ' ' || base_name
         WHEN event_id % 59 = 0 THEN '_' || base_name
         ELSE base_name END AS Name,
    CASE WHEN event_id % 37 = 0 THEN 'n/a'
         WHEN event_id % 41 = 0 THEN CAST(event_id AS VARCHAR) || '.5'
         WHEN event_id % 43 = 0 THEN NULL
         WHEN event_id % 47 = 0 THEN '2000'
         ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS Points
  FROM (SELECT *, event_type || '_' || CAST(user_id AS VARCHAR) || ' x' AS base_name FROM events) e
)"""



def of_events(where: str) -> str:
    """The feed of a part of the events."""
    return PARTICIPATION.replace("FROM events)", f"FROM events WHERE {where})")


INLINE = ", ".join(f"('{k}', {'NULL' if p is None else repr(p)})" for k, p in INLINE_ROWS)

LATE = """
late AS (
  SELECT DISTINCT UUID, CAST(NULL AS VARCHAR) AS Name, '250' AS Points FROM participation WHERE UUID IS NOT NULL
)"""


def typed(source: str = "participation") -> str:
    return f"typed AS (SELECT UUID, Name, Points, {POINTS_INT} AS points_int FROM {source})"


def monolith_silver(source: str = "participation") -> str:
    return (
        f"{typed(source)},\nmonolith_silver AS (SELECT UUID, Name, Points, points_int, "
        f"{band_sql('points_int', closed_top=True)} AS band, {FIRST_UNGUARDED} AS first_name_split, "
        f"{FIRST_GUARDED} AS first_name FROM typed)"
    )


CUSTOMERS_SILVER = (
    f"{typed()},\ncustomers_silver AS (SELECT UUID AS member_id, {FIRST_GUARDED} AS first_name, "
    f"points_int AS points, {band_sql('points_int')} AS band FROM typed)"
)

# Customers gold: what a (member, band) group holds, then the columns of the contract.
GOLD = f"""
SELECT band, member_id, first_name, min_points, max_points, participations, total_points,
       {dec_avg('total_points', 'valued')} AS avg_points
FROM (
  SELECT band, member_id, COUNT(points) AS valued, COUNT(member_id) AS participations,
         SUM(points)::BIGINT AS total_points, MIN(points) AS min_points, MAX(points) AS max_points,
         MAX(first_name) AS first_name
  FROM customers_silver GROUP BY ALL) of_group"""

PER_KEY = """
SELECT UUID AS member_id, AVG(points_int) AS avg_points, CAST(SUM(points_int) AS BIGINT) AS total_points,
       MIN(points_int) AS min_points, MAX(points_int) AS max_points, COUNT(UUID) AS participations
FROM monolith_silver GROUP BY UUID"""

# Key-wide totals over raw rows by one named window, then one row per member and band.
WINDOW_GOLD = f"""
SELECT DISTINCT band, member_id, first_name, min_points, max_points, participations, total_points,
       {dec_avg('total_points', 'valued')} AS avg_points
FROM (
  SELECT band, UUID AS member_id, COUNT(points_int) OVER of_key AS valued, COUNT(UUID) OVER of_key AS participations,
         (SUM(points_int) OVER of_key)::BIGINT AS total_points, MIN(points_int) OVER of_key AS min_points,
         MAX(points_int) OVER of_key AS max_points, MAX(first_name_split) OVER of_key AS first_name
  FROM monolith_silver WINDOW of_key AS (PARTITION BY UUID)) of_row"""

# By definition: the distinct (member, name, band) groups, each with its member's totals if there are any.
VALIDATION = """
SELECT seen.member_id, seen.first_name, seen.band, per_key.min_points, per_key.max_points, per_key.avg_points,
       per_key.total_points, per_key.participations
FROM (SELECT DISTINCT UUID AS member_id, first_name_split AS first_name, band FROM monolith_silver) seen
LEFT JOIN per_key USING (member_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _validation(order: bool) -> str:
    sql = _with(PARTICIPATION, monolith_silver(), f"per_key AS ({PER_KEY})") + VALIDATION
    return sql + "\nORDER BY participations DESC" if order else sql


PRODUCT_FEED = "CAST(p_partkey AS VARCHAR)"

ORACLE: dict[str, str] = {
    # scans and sources
    "scan_csv_schema": _with(PARTICIPATION) + "SELECT UUID, Name, Points, TRUE AS has_source_file FROM participation",
    "scan_csv_infer_dir": _with(PARTICIPATION)
    + "SELECT CAST(UUID AS INTEGER) AS UUID, Name, Points, TRUE AS has_source_file FROM participation",
    "scan_csv_preview": _with(PARTICIPATION) + "SELECT UUID, Name, Points FROM participation",
    "scan_file_provenance": _with(PARTICIPATION)
    + "SELECT UUID, Name, Points, TRUE AS file_listed, TRUE AS file_dated, TRUE AS stamped FROM participation",
    "filter_by_source_file": _with(of_events("event_id % 2 = 0")) + "SELECT UUID, Name, Points FROM participation",
    "scan_layer_table": _with(PARTICIPATION) + "SELECT UUID, Name, Points FROM participation",
    # sinks
    "sink_overwrite": _with(PARTICIPATION) + "SELECT UUID, Name, Points FROM participation",
    "sink_overwrite_schema": _with(PARTICIPATION, CUSTOMERS_SILVER) + "SELECT * FROM customers_silver",
    "sink_append_evolve": _with(PARTICIPATION, LATE)
    + "SELECT UUID, Name, Points, CAST(NULL AS VARCHAR) AS arrival FROM participation "
    "UNION ALL SELECT UUID, Name, Points, 'late' AS arrival FROM late",
    "sink_ctas_replace": _with(PARTICIPATION, CUSTOMERS_SILVER)
    + "SELECT band, first_name, COUNT(*) AS entries, CAST(SUM(points) AS BIGINT) AS points FROM customers_silver GROUP BY ALL",
    "sink_insert_partial": _with(PARTICIPATION, LATE)
    + "SELECT UUID, Name, Points FROM participation UNION ALL SELECT UUID, Name, Points FROM late",
    "sink_insert_values": _with(PARTICIPATION)
    + "SELECT UUID, Name, Points, TRUE AS has_file, TRUE AS stamped FROM participation "
    f"UNION ALL SELECT k, NULL, p, FALSE, FALSE FROM (VALUES {INLINE}) v(k, p)",
    "temp_view": _with(PARTICIPATION, monolith_silver()) + PER_KEY,
    # projections, predicates, functions
    "project_star_plus": _with(PARTICIPATION) + "SELECT UUID, Name, Points, TRUE AS stamped FROM participation",
    "project_rename": f"SELECT {PRODUCT_FEED} AS item_code, p_type AS message_kind, p_name AS message_text FROM part",
    "project_with_columns": _with(PARTICIPATION)
    + f"SELECT UUID, Name, Points, {FIRST_GUARDED} AS first_name, {POINTS_INT} AS points_int FROM participation",
    "project_chained": _with(PARTICIPATION, typed())
    + f"SELECT UUID, Name, Points, points_int, {band_sql('points_int', closed_top=True)} AS band, "
    f"({band_sql('points_int', closed_top=True)}) = '{BAND_LABELS[-1]}' AS is_top FROM typed",
    "silver_customers": _with(PARTICIPATION, CUSTOMERS_SILVER) + "SELECT * FROM customers_silver",
    "project_drop": _with(PARTICIPATION) + "SELECT UUID, Name, Points FROM participation",
    "stamp_ingestion": _with(PARTICIPATION, CUSTOMERS_SILVER, f"gold AS ({GOLD})")
    + "SELECT layer, COUNT(*) AS row_count, COUNT(k) AS keyed_rows, CAST(1 AS BIGINT) AS stamps, TRUE AS in_order FROM ("
    "SELECT 'bronze' AS layer, UUID AS k FROM participation UNION ALL SELECT 'silver', member_id FROM customers_silver "
    "UNION ALL SELECT 'gold', member_id FROM gold) l GROUP BY layer",
    "case_insensitive_columns": _with(PARTICIPATION)
    + f"SELECT UUID AS uuid, Name AS name, {POINTS_INT} AS points_int FROM participation",
    "predicate_range": _with(PARTICIPATION, typed())
    + "SELECT UUID, points_int FROM typed WHERE points_int >= 1000 AND points_int <= 2000",
    "predicate_is_null": _with(PARTICIPATION, typed())
    + "SELECT UUID, Points, points_int IS NULL AS invalid_points FROM typed",
    "case_when": _with(PARTICIPATION, typed())
    + "SELECT UUID, Points, "
    + band_sql("points_int", labels=BAND_LABELS_PT, invalid=INVALID_LABEL_PT)
    + " AS band FROM typed",
    "band_half_open": _with(PARTICIPATION, typed()) + f"SELECT UUID, Points, {band_sql('points_int')} AS band FROM typed",
    "band_closed": _with(PARTICIPATION, typed())
    + f"SELECT UUID, Points, {band_sql('points_int', closed_top=True)} AS band FROM typed",
    "band_unguarded": _with(PARTICIPATION, typed())
    + f"SELECT UUID, Points, {band_sql('points_int', closed_top=True, guarded=False)} AS band FROM typed",
    "first_name": _with(PARTICIPATION) + f"SELECT Name, {FIRST_GUARDED} AS first_name FROM participation",
    "first_name_no_guard": _with(PARTICIPATION) + f"SELECT Name, {FIRST_UNGUARDED} AS first_name FROM participation",
    "first_token_upper": _with(PARTICIPATION) + f"SELECT Name, {FIRST_TOKEN} AS first_token FROM participation",
    "first_name_udf": _with(PARTICIPATION) + f"SELECT Name, {FIRST_GUARDED} AS first_name FROM participation",
    "try_cast_int": _with(PARTICIPATION) + f"SELECT Points, {POINTS_INT} AS points_int FROM participation",
    "cast_decimal": _with(PARTICIPATION, monolith_silver())
    + f"SELECT UUID AS member_id, {dec_avg('CAST(SUM(points_int) AS BIGINT)', 'COUNT(points_int)')} AS avg_points "
    "FROM monolith_silver GROUP BY UUID",
    "split_get_item": _with(PARTICIPATION)
    + "SELECT Name, split_part(Name, ' ', 1) AS before_space, split_part(Name, '_', 1) AS before_underscore "
    "FROM participation",
    # aggregates, join, windows, sort
    "agg_per_key": _with(PARTICIPATION, monolith_silver()) + PER_KEY,
    "gold_by_key_and_band": _with(PARTICIPATION, CUSTOMERS_SILVER) + GOLD,
    "gold_many_names": _with(
        PARTICIPATION.replace("CAST(user_id AS VARCHAR) END AS UUID,", "CAST(user_id AS VARCHAR) END AS UUID, event_id, user_id,"),
        f"customers_silver AS (SELECT UUID AS member_id, (CASE WHEN user_id % 3 = 0 THEN 'M' ELSE 'Longer-than-a-code-' END) || event_id AS first_name, "
        f"{POINTS_INT} AS points, {band_sql(f'({POINTS_INT})')} AS band FROM participation)",
    )
    + GOLD,
    "group_by_all": _with(PARTICIPATION, monolith_silver())
    + "SELECT UUID AS member_id, first_name_split AS first_name, band, COUNT(UUID) AS participations, "
    "CAST(SUM(points_int) AS BIGINT) AS total_points FROM monolith_silver GROUP BY ALL",
    "count_column_nulls": _with(PARTICIPATION, monolith_silver())
    + "SELECT UUID AS member_id, COUNT(UUID) AS key_count, COUNT(1) AS row_count, "
    "CAST(SUM(points_int) AS BIGINT) AS total_points FROM monolith_silver GROUP BY UUID",
    "agg_all_null_group": _with(PARTICIPATION, CUSTOMERS_SILVER, f"g AS ({GOLD})")
    + f"SELECT * FROM g WHERE band = '{INVALID_LABEL}'",
    "distinct_values": _with(PARTICIPATION) + "SELECT DISTINCT Points FROM participation",
    "validate_join_left": _validation(order=False),
    "window_totals": _with(PARTICIPATION, monolith_silver()) + WINDOW_GOLD,
    "gold_window": _with(PARTICIPATION, monolith_silver()) + WINDOW_GOLD,
    "window_each_aggregate": _with(PARTICIPATION, monolith_silver())
    + f"""SELECT r.UUID, r.first_name_split, r.points_int, t.* EXCLUDE (of_key)
FROM monolith_silver r JOIN (
  SELECT UUID AS of_key, COUNT(UUID) AS key_participations, MIN(points_int) AS key_min_points, MAX(points_int) AS key_max_points,
         SUM(points_int)::BIGINT AS key_total_points, {dec_avg('SUM(points_int)::BIGINT', 'COUNT(points_int)')} AS key_avg_points,
         MAX(first_name_split) AS key_first_name
  FROM monolith_silver GROUP BY ALL) t ON r.UUID IS NOT DISTINCT FROM t.of_key""",
    "sort_desc_alias": _validation(order=True),
    # composite flows
    "bronze_customers": _with(PARTICIPATION) + "SELECT UUID, Name, Points, TRUE AS has_source_file FROM participation",
    "bronze_with_rejects": _with(PARTICIPATION.replace("SELECT\n", "SELECT event_id,\n", 1))
    + """, lines AS (
  SELECT *, event_id % 29 = 0 OR event_id % 31 = 0 AS bad,
         COALESCE(UUID, '') || ';' || Name || CASE WHEN event_id % 29 = 0 THEN ';' || COALESCE(Points, '') || ';surplus' ELSE '' END AS line
  FROM participation)
SELECT CASE WHEN NOT bad THEN UUID END AS UUID, CASE WHEN NOT bad THEN Name END AS Name,
       CASE WHEN NOT bad THEN Points END AS Points, CASE WHEN bad THEN line END AS line,
       (SELECT COUNT(*) FROM lines WHERE NOT bad) AS n_rows, (SELECT COUNT(*) FROM lines WHERE bad) AS n_rejects
FROM lines""",
    "bronze_products": f'SELECT {PRODUCT_FEED} AS "1", p_type AS ChatMessage, p_name AS Mensagem_do_chat_da_Twitch, '
    "TRUE AS has_source_file FROM part",
    "silver_products": f"SELECT {PRODUCT_FEED} AS item_code, p_type AS message_kind, p_name AS message_text FROM part",
    "silver_monolith": _with(PARTICIPATION, monolith_silver()) + "SELECT * FROM monolith_silver",
    "rebuild_after_insert": _with(
        PARTICIPATION,
        LATE,
        "bronze AS (SELECT UUID, Name, Points FROM participation UNION ALL SELECT UUID, Name, Points FROM late)",
        monolith_silver("bronze"),
    )
    + WINDOW_GOLD,
    "batch_repeated": _with(PARTICIPATION, LATE)
    + "SELECT UUID, Name, Points, 'first' AS batch_id FROM participation UNION ALL SELECT UUID, Name, Points, 'late' FROM late",
    "gold_by_batches": _with(
        PARTICIPATION,
        LATE,
        "bronze AS (SELECT UUID, Name, Points FROM participation UNION ALL SELECT UUID, Name, Points FROM late)",
        monolith_silver("bronze"),
    )
    + WINDOW_GOLD,
    "sink_stable_name": _with(PARTICIPATION, LATE, CUSTOMERS_SILVER)
    + "SELECT * FROM customers_silver UNION ALL SELECT UUID, NULL, 250, NULL FROM late",
    "mixed_folder": _with(PARTICIPATION)
    + "SELECT 'customers' AS feed, UUID AS a, Name AS b, Points AS c FROM participation "
    f"UNION ALL SELECT 'products', {PRODUCT_FEED}, p_type, p_name FROM part",
    "scan_infer_once": _with(PARTICIPATION)
    + "SELECT CAST(UUID AS INTEGER) AS UUID, Name, Points, TRUE AS has_source_file FROM participation",
    "layers_resumed": _with(PARTICIPATION, CUSTOMERS_SILVER) + GOLD,
    "monolith_end_to_end": _with(
        PARTICIPATION,
        f"bronze AS (SELECT CAST(UUID AS INTEGER) AS UUID, Name, Points FROM participation "
        f"UNION ALL SELECT CAST(k AS INTEGER), NULL, p FROM (VALUES {INLINE}) v(k, p))",
        monolith_silver("bronze"),
    )
    + WINDOW_GOLD,
    "layers_two_files": " UNION ALL ".join(
        f"SELECT '{part}' AS part, * FROM ({_with(of_events(f'event_id % 2 {keep} 0'), CUSTOMERS_SILVER)}{GOLD}) {part}"
        for part, keep in (("even", "="), ("odd", "<>"))
    ),
    "layers_end_to_end": _with(PARTICIPATION, CUSTOMERS_SILVER) + GOLD,
}
