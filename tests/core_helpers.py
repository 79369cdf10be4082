"""Paths and comparisons that the tests share."""

from __future__ import annotations

from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Rows as sorted tuples of the given columns (NULL sorts first)."""
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))


def same_rows(a, b) -> bool:
    """Multiset equality of two DataFrames with the same columns."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
