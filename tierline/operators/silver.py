"""Bronze -> silver: narrow projections only (no shuffle, no Python)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import (
    BAND_BOUNDS,
    BAND_LABELS,
    INVALID_LABEL,
    band,
    first_name,
    first_name_unguarded,
    stamp,
    to_int,
)
from tierline.sources.feeds import FILE_NAME, INGESTED_AT


def silver_customers(
    bronze: DataFrame,
    bounds: Sequence[int] = BAND_BOUNDS,
    labels: Sequence[str] = BAND_LABELS,
    invalid_label: str = INVALID_LABEL,
    use_udf: bool = False,
    with_stamp: bool = True,
) -> DataFrame:
    """Customers silver: key, first name, tolerant int points, half-open band.

    Raw name, provenance and the bronze stamp are dropped. ``use_udf`` swaps
    the native first-name rule for the Arrow UDF (same result, slower).
    """
    points = to_int("Points")
    if use_udf:
        from tierline.functions.udf import first_name_arrow

        name = first_name_arrow(F.col("Name"))
    else:
        name = first_name("Name")
    cols = [
        F.col("UUID").alias("member_id"),
        name.alias("first_name"),
        points.alias("points"),
        band(points, bounds, labels, invalid_label, closed_top=False).alias("band"),
    ]
    if with_stamp:
        cols.append(stamp().alias(INGESTED_AT))
    return bronze.select(*cols)


def silver_products(bronze: DataFrame, with_stamp: bool = True) -> DataFrame:
    """Products silver: the three feed columns renamed (one is literally ``1``)."""
    cols = [
        F.col("`1`").alias("item_code"),
        F.col("ChatMessage").alias("message_kind"),
        F.col("Mensagem_do_chat_da_Twitch").alias("message_text"),
    ]
    if with_stamp:
        cols.append(stamp().alias(INGESTED_AT))
    return bronze.select(*cols)


def silver_monolith(
    bronze: DataFrame,
    bounds: Sequence[int] = BAND_BOUNDS,
    labels: Sequence[str] = BAND_LABELS,
    invalid_label: str | None = INVALID_LABEL,
    use_udf: bool = False,
) -> DataFrame:
    """Single-table silver: bronze columns kept, metadata dropped, four added.

    ``points_int`` (tolerant int), ``band`` (closed middle band: 2000 is in
    the middle), ``first_name_split`` (split rule without the empty guard)
    and ``first_name`` (guarded rule). Each later column refers to the earlier
    computed ``points_int``; Catalyst collapses the chain into one projection.
    """
    if use_udf:
        from tierline.functions.udf import first_name_arrow

        guarded = first_name_arrow(F.col("Name"))
    else:
        guarded = first_name("Name")
    return (
        bronze.withColumn("points_int", to_int("Points"))
        .withColumn("band", band("points_int", bounds, labels, invalid_label, closed_top=True))
        .withColumn("first_name_split", first_name_unguarded("Name"))
        .withColumn("first_name", guarded)
        .drop(FILE_NAME, INGESTED_AT)
    )
