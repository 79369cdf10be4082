"""Feed specifications and layer-table naming."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType


def _all_strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


@dataclass(frozen=True)
class FeedSpec:
    """How one delimited feed is read.

    The schema binds columns **by position**: a header line is skipped, not
    matched against the declared names.
    """

    name: str
    schema: StructType
    sep: str = ";"
    header: bool = True
    key: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        opts = {"sep": self.sep, "header": str(self.header).lower()}
        opts.update(self.options)
        return opts


# ---------------------------------------------------------------------------
# The declared column names of the two feeds. They are the feed
# contract of the source feeds (bronze tables carry these names), kept as is.
# ---------------------------------------------------------------------------
CUSTOMERS = FeedSpec(
    name="customers",
    schema=_all_strings("UUID", "Name", "Points"),
    key="UUID",
)
PRODUCTS = FeedSpec(
    name="products",
    schema=_all_strings("1", "ChatMessage", "Mensagem_do_chat_da_Twitch"),
    key="1",
)

FEEDS: dict[str, FeedSpec] = {CUSTOMERS.name: CUSTOMERS, PRODUCTS.name: PRODUCTS}

LAYERS = ("bronze", "silver", "gold")
#: Tables beside the layers: lines that a load rejected, combined statistics by batch.
SIDE_TABLES = ("rejects", "partials")


def spec_for(file_name: str) -> FeedSpec:
    """Pick the spec whose name occurs in ``file_name``; unknown names raise."""
    lowered = file_name.lower()
    for spec in FEEDS.values():
        if spec.name in lowered:
            return spec
    raise ValueError(f"no feed spec matches {file_name!r}")


def dataset_name(file_name: str) -> str:
    """``'Customers.csv'`` -> ``'customers'``."""
    lowered = file_name.lower()
    return lowered[: -len(".csv")] if lowered.endswith(".csv") else lowered


def layer_table(dataset: str, layer: str, schema: str | None = None, catalog: str | None = None) -> str:
    """Table name ``[catalog.][schema.]tab_<dataset>_<layer>`` with quoted parts."""
    if layer not in (*LAYERS, *SIDE_TABLES):
        raise ValueError(f"layer must be one of {(*LAYERS, *SIDE_TABLES)}, got {layer!r}")
    parts = [p for p in (catalog, schema) if p] + [f"tab_{dataset_name(dataset)}_{layer}"]
    return ".".join(f"`{p}`" for p in parts)
