"""Feed readers, provenance, table scans and driver-table derivations."""

from tierline.sources.derived import late_rows, participation, product_feed, staged_feed, write_feed
from tierline.sources.feeds import (
    FILE_NAME,
    INGESTED_AT,
    file_inventory,
    only_source_file,
    preview_feed,
    provenance,
    read_feed,
    read_feed_inferred,
    read_layer,
)

__all__ = [
    "FILE_NAME",
    "INGESTED_AT",
    "file_inventory",
    "late_rows",
    "only_source_file",
    "participation",
    "preview_feed",
    "product_feed",
    "provenance",
    "read_feed",
    "read_feed_inferred",
    "read_layer",
    "staged_feed",
    "write_feed",
]
