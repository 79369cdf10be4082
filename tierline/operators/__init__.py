"""Layer transforms and table sinks."""

from tierline.operators.gold import (
    distinct_values,
    gold_by_key_and_band,
    group_by_all_sql,
    per_key_totals,
    sort_desc,
    validation_report,
    window_totals,
    with_key_totals,
)
from tierline.operators.silver import silver_customers, silver_monolith, silver_products

__all__ = [
    "distinct_values",
    "gold_by_key_and_band",
    "group_by_all_sql",
    "per_key_totals",
    "silver_customers",
    "silver_monolith",
    "silver_products",
    "sort_desc",
    "validation_report",
    "window_totals",
    "with_key_totals",
]
