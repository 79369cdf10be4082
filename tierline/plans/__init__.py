"""Composite flows and the registered query set."""

from tierline.plans.flow import (
    Target,
    build_gold,
    build_monolith_gold,
    build_monolith_silver,
    build_silver,
    ingest_bronze,
    rebuild_after_insert,
    run_layers,
)

__all__ = [
    "Target",
    "build_gold",
    "build_monolith_gold",
    "build_monolith_silver",
    "build_silver",
    "ingest_bronze",
    "rebuild_after_insert",
    "run_layers",
]
