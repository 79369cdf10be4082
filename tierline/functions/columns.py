"""Scalar column builders.

All of these return ``Column`` expressions made of built-in Spark functions,
so they stay inside whole-stage codegen and never cross into Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Band bounds and labels.
# The bounds 1000 and 2000 and the Portuguese label texts are the values the
# source notebooks use; the English set is our default.
# ---------------------------------------------------------------------------
BAND_BOUNDS = (1000, 2000)
BAND_LABELS = ("below_1000", "1000_to_2000", "above_2000")
INVALID_LABEL = "invalid"
BAND_LABELS_PT = ("Abaixo de 1000", "Entre 1000 e 2000", "Acima de 2000")
INVALID_LABEL_PT = "Valor Inválido"
INVALID_LABEL_PT_EARLY = "Dados inválidos"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: ColumnOrName) -> Column:
    """Tolerant integer cast: anything that is not an integer literal is NULL.

    ``'12.5'``, ``'1e3'``, ``'abc'``, ``''`` and out-of-range values give NULL;
    surrounding blanks are ignored (``' 7 '`` -> 7). Never raises, ANSI or not.
    """
    return _col(c).try_cast("int")


def to_decimal(c: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """Cast to ``decimal(precision, scale)`` rounding half-up.

    Under ANSI mode an overflow raises, as a plain ``CAST`` does; widen
    ``precision`` when averages can pass ``10**(precision-scale)``.
    """
    return _col(c).cast(f"decimal({precision},{scale})")


def band(
    value: ColumnOrName,
    bounds: Sequence[int] = BAND_BOUNDS,
    labels: Sequence[str] = BAND_LABELS,
    invalid_label: str | None = INVALID_LABEL,
    closed_top: bool = False,
) -> Column:
    """First-match band of an integer column.

    ``labels`` has one entry more than ``bounds``. Band ``i`` holds values
    below ``bounds[i]``; with ``closed_top`` the last bound belongs to the band
    under it (``<= 2000`` instead of ``< 2000``). When ``invalid_label`` is set,
    NULL gets it; when it is ``None`` a NULL matches no comparison and falls
    through to the top label, as an unguarded CASE does.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("labels must have exactly one entry more than bounds")
    v = _col(value)
    expr = None
    if invalid_label is not None:
        expr = F.when(v.isNull(), F.lit(invalid_label))
    last = len(bounds) - 1
    for i, bound in enumerate(bounds):
        cond = (v <= bound) if (closed_top and i == last) else (v < bound)
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    if expr is None:
        return F.lit(labels[-1])
    return expr.otherwise(F.lit(labels[-1]))


def _head(c: Column, sep: str) -> Column:
    # Text before the first ``sep`` (all of it when absent): the same value as
    # ``split(c, sep)[0]`` for a one-character literal separator, computed on
    # the UTF-8 bytes without a regex or an intermediate array.
    return F.substring_index(c, sep, 1)


def first_name_unguarded(c: ColumnOrName) -> Column:
    """Text before the first space, then before the first ``_``, upper-cased.

    NULL stays NULL and ``''`` stays ``''``.
    """
    return F.upper(_head(_head(_col(c), " "), "_"))


def first_name(c: ColumnOrName) -> Column:
    """Guarded first name: like :func:`first_name_unguarded`, but NULL for ``''``."""
    col = _col(c)
    return F.when(F.length(col) > 0, first_name_unguarded(col))


def first_token_upper(c: ColumnOrName) -> Column:
    """Upper-cased text before the first space only."""
    return F.upper(_head(_col(c), " "))


def stamp() -> Column:
    """Processing-time stamp; one value for the whole query."""
    return F.current_timestamp()
