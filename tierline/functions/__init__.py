"""Column expressions: tolerant casts, value bands, first-name extraction."""

from tierline.functions.columns import (
    BAND_LABELS,
    BAND_LABELS_PT,
    INVALID_LABEL,
    INVALID_LABEL_PT,
    INVALID_LABEL_PT_EARLY,
    band,
    first_name,
    first_name_unguarded,
    first_token_upper,
    stamp,
    to_decimal,
    to_int,
)

__all__ = [
    "BAND_LABELS",
    "BAND_LABELS_PT",
    "INVALID_LABEL",
    "INVALID_LABEL_PT",
    "INVALID_LABEL_PT_EARLY",
    "band",
    "first_name",
    "first_name_unguarded",
    "first_token_upper",
    "stamp",
    "to_decimal",
    "to_int",
]
