"""Gold and window totals against a plain-Python model of the rules, on
random frames (keys with NULL, names with blanks/underscores/empties,
valid, invalid, out-of-range and NULL points)."""

from __future__ import annotations

import re
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.operators.gold import gold_by_key_and_band, validation_report, window_totals
from tierline.operators.silver import silver_customers, silver_monolith

INT = re.compile(r"^ *[+-]?[0-9]+ *$")


def to_int(s):
    if s is None or not INT.match(s):
        return None
    v = int(s.strip())
    return v if -(2**31) <= v < 2**31 else None


def band(p, closed):
    if p is None:
        return "invalid"
    if p < 1000:
        return "below_1000"
    if p < 2000 or (closed and p == 2000):
        return "1000_to_2000"
    return "above_2000"


def head(s):
    """The longest beginning without a blank or an underscore, upper-cased."""
    return None if s is None else re.match("[^ _]*", s)[0].upper()


def guarded(s):
    return head(s) if s else None


def dec(total, n):
    return None if not n else (Decimal(total) / Decimal(n)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def smax(values):
    present = [v for v in values if v is not None]
    return max(present, key=lambda v: v.encode()) if present else None


def stats(rows):
    pts = [p for _, p in rows if p is not None]
    return {
        "count": sum(1 for k, _ in rows if k is not None),
        "total": sum(pts) if pts else None,
        "n": len(pts),
        "min": min(pts) if pts else None,
        "max": max(pts) if pts else None,
    }


def model_gold(data):
    groups = defaultdict(list)
    for key, name, points in data:
        p = to_int(points)
        groups[(key, band(p, closed=False))].append((key, guarded(name), p))
    out = set()
    for (key, b), rows in groups.items():
        s = stats([(k, p) for k, _, p in rows])
        out.add((key, b, smax([n for _, n, _ in rows]), s["count"], s["total"], dec(s["total"], s["n"]), s["min"], s["max"]))
    return out


def model_window(data):
    per_key = defaultdict(list)
    bands = defaultdict(set)
    for key, name, points in data:
        p = to_int(points)
        per_key[key].append((key, head(name), p))
        bands[key].add(band(p, closed=True))
    out = set()
    for key, rows in per_key.items():
        s = stats([(k, p) for k, _, p in rows])
        for b in bands[key]:
            out.add((key, b, smax([n for _, n, _ in rows]), s["count"], s["total"], dec(s["total"], s["n"]), s["min"], s["max"]))
    return out


KEYS = st.sampled_from(["a", "b", "hot", None])
NAMES = st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("ab_ Xy")), max_size=6))
POINTS = st.one_of(
    st.none(),
    st.integers(min_value=-50, max_value=3000).map(str),
    st.sampled_from(["2000", "999", "1000", "12.5", "1e3", "n/a", "", " 7 ", "+4", "99999999999"]),
)
ROWS = st.lists(st.tuples(KEYS, NAMES, POINTS), min_size=1, max_size=40)
GOLD = ("member_id", "band", "first_name", "participations", "total_points", "avg_points", "min_points", "max_points")


@settings(max_examples=25, deadline=None)
@given(ROWS)
def test_gold_matches_model(spark, data):
    df = spark.createDataFrame(data, "UUID string, Name string, Points string")
    got = {tuple(r[c] for c in GOLD) for r in gold_by_key_and_band(silver_customers(df), with_stamp=False).collect()}
    assert got == model_gold(data)


@settings(max_examples=25, deadline=None)
@given(ROWS)
def test_window_totals_match_model(spark, data):
    df = spark.createDataFrame(data, "UUID string, Name string, Points string")
    got = {tuple(r[c] for c in GOLD) for r in window_totals(silver_monolith(df)).collect()}
    assert got == model_window(data)


@settings(max_examples=10, deadline=None)
@given(ROWS)
def test_validation_report_matches_model(spark, data):
    df = spark.createDataFrame(data, "UUID string, Name string, Points string")
    got = {(r["member_id"], r["first_name"], r["band"], r["participations"], r["total_points"], r["min_points"], r["max_points"])
           for r in validation_report(silver_monolith(df), ordered=False).collect()}
    per_key = defaultdict(list)
    groups = set()
    for key, name, points in data:
        p = to_int(points)
        per_key[key].append((key, p))
        groups.add((key, head(name), band(p, closed=True)))
    want = set()
    for key, name, b in groups:
        if key is None:
            want.add((None, name, b, None, None, None, None))
        else:
            s = stats(per_key[key])
            want.add((key, name, b, s["count"], s["total"], s["min"], s["max"]))
    assert got == want
