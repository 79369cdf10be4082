"""tierline: layered (bronze / silver / gold) batch tables on Spark.

Every transform is a pure ``DataFrame -> DataFrame`` function built from
native Spark expressions, so Catalyst plans it and whole-stage codegen runs it.
Sinks go through the session catalog. Nothing runs at import time.
"""

from tierline.functions.columns import (
    BAND_LABELS,
    INVALID_LABEL,
    band,
    first_name,
    first_name_unguarded,
    first_token_upper,
    stamp,
    to_decimal,
    to_int,
)
from tierline.operators.gold import (
    gold_by_key_and_band,
    per_key_totals,
    validation_report,
    window_totals,
    with_key_totals,
)
from tierline.operators.silver import silver_customers, silver_monolith, silver_products
from tierline.operators.sinks import append_evolving, insert_by_name, overwrite_table, replace_table_as, save_table
from tierline.plans.flow import Target, build_gold, build_silver, ingest_bronze, rebuild_after_insert, run_layers
from tierline.session import build_session
from tierline.sources.feeds import file_inventory, preview_feed, read_feed, read_feed_inferred, read_layer
from tierline.specs import FEEDS, FeedSpec, dataset_name, layer_table, spec_for

__all__ = [
    "BAND_LABELS",
    "FEEDS",
    "INVALID_LABEL",
    "FeedSpec",
    "Target",
    "append_evolving",
    "band",
    "build_gold",
    "build_session",
    "build_silver",
    "dataset_name",
    "file_inventory",
    "first_name",
    "first_name_unguarded",
    "first_token_upper",
    "gold_by_key_and_band",
    "ingest_bronze",
    "insert_by_name",
    "layer_table",
    "overwrite_table",
    "per_key_totals",
    "preview_feed",
    "read_feed",
    "read_feed_inferred",
    "read_layer",
    "rebuild_after_insert",
    "replace_table_as",
    "run_layers",
    "save_table",
    "silver_customers",
    "silver_monolith",
    "silver_products",
    "spec_for",
    "stamp",
    "to_decimal",
    "to_int",
    "validation_report",
    "window_totals",
    "with_key_totals",
]
