"""Scalar rules on the edge fixture, plus property tests."""

from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from core_helpers import rows
from tierline.functions.columns import (
    BAND_LABELS_PT,
    INVALID_LABEL_PT,
    band,
    first_name,
    first_name_unguarded,
    first_token_upper,
    to_decimal,
    to_int,
)
from tierline.functions.udf import first_name_arrow

B, M, A, INV = "below_1000", "1000_to_2000", "above_2000", "invalid"


def test_to_int_cases(spark):
    cases = ["12", "+4", " 7 ", "12.5", "1e3", "abc", "", None, "99999999999", "-3"]
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    got = {r["p"]: r["v"] for r in df.select("p", to_int("p").alias("v")).collect()}
    assert got == {"12": 12, "+4": 4, " 7 ": 7, "12.5": None, "1e3": None, "abc": None, "": None,
                   None: None, "99999999999": None, "-3": -3}


def test_bands_on_edge_fixture(edge):
    p = to_int("Points")
    df = edge.select(
        "UUID", "Points",
        band(p).alias("b1"),
        band(p, closed_top=True).alias("b2"),
        band(p, closed_top=True, invalid_label=None).alias("b3"),
    )
    got = {(r["UUID"], r["Points"]): (r["b1"], r["b2"], r["b3"]) for r in df.collect()}
    assert got[("u1", "999")] == (B, B, B)
    assert got[("u1", "1000")] == (M, M, M)
    assert got[("u1", "abc")] == (INV, INV, A)
    assert got[("u2", "2000")] == (A, M, M)  # 2000: top band half-open, middle band closed
    assert got[("u2", "2001")] == (A, A, A)
    assert got[("u3", "12.5")] == (INV, INV, A)
    assert got[("u4", None)] == (INV, INV, A)
    assert got[("u5", " 7 ")] == (B, B, B)
    assert got[(None, "10")] == (B, B, B)
    assert got[("u6", "-3")] == (B, B, B)
    assert got[("u6", "99999999999")] == (INV, INV, A)


def test_band_labels_are_parameters(spark):
    df = spark.createDataFrame([("5",), ("1500",), ("x",)], "p string")
    out = rows(df.select(band(to_int("p"), labels=BAND_LABELS_PT, invalid_label=INVALID_LABEL_PT).alias("b")), "b")
    assert out == [("Abaixo de 1000",), ("Entre 1000 e 2000",), ("Valor Inválido",)]


def test_band_rejects_bad_labels():
    with pytest.raises(ValueError):
        band("x", bounds=(1, 2), labels=("a", "b"))


def test_first_names_on_edge_fixture(edge):
    df = edge.select(
        "Name",
        first_name("Name").alias("n1"),
        first_name_unguarded("Name").alias("n2"),
        first_token_upper("Name").alias("n3"),
        first_name_arrow(F.col("Name")).alias("udf"),
    ).distinct()
    got = {r["Name"]: (r["n1"], r["n2"], r["n3"], r["udf"]) for r in df.collect()}
    assert got["Ana_Souza x"] == ("ANA", "ANA", "ANA_SOUZA", "ANA")
    assert got["bob lee"] == ("BOB", "BOB", "BOB", "BOB")
    assert got[None] == (None, None, None, None)
    assert got[""] == (None, "", "", None)
    assert got[" lead"] == ("", "", "", "")
    assert got["NoId"] == ("NOID", "NOID", "NOID", "NOID")
    assert got["_x y"] == ("", "", "_X", "")
    assert got["plain"] == ("PLAIN", "PLAIN", "PLAIN", "PLAIN")


def test_decimal_cast_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2000.5,), (-3.0,), (None,)], "v double")
    got = rows(df.select(to_decimal("v").alias("d")), "d")
    assert got == [(None,), (Decimal("-3.00"),), (Decimal("1.01"),), (Decimal("2000.50"),)]


# -- properties -----------------------------------------------------------------

TEXT = st.text(alphabet=st.sampled_from(list("ab_ -+0179.eXYé\t")), max_size=12)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=30))
def test_properties_of_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    p = to_int("s")
    out = df.select(
        "s",
        p.alias("p"),
        band(p).alias("b"),
        first_name("s").alias("n1"),
        first_name_unguarded("s").alias("n2"),
        F.upper(F.regexp_extract("s", "^[^ _]*", 0)).alias("n2_rule"),
        first_name_arrow(F.col("s")).alias("udf"),
    ).collect()
    for r in out:
        # band: total and disjoint (exactly one label, never NULL)
        assert r["b"] in {B, M, A, INV}
        assert (r["b"] == INV) == (r["p"] is None)
        # the longest beginning without a blank or an underscore
        assert r["n2"] == r["n2_rule"]
        # guarded rule: NULL exactly for NULL or '' input, else the unguarded one
        assert r["n1"] == (None if not r["s"] else r["n2"])
        # the Arrow UDF equals the native rule
        assert r["udf"] == r["n1"]
    # idempotent wherever non-empty
    again = spark.createDataFrame([(r["n1"],) for r in out if r["n1"]], "s string")
    if again.count():
        assert all(r["a"] == r["s"] for r in again.select("s", first_name("s").alias("a")).collect())


def test_decimal_overflow_raises_and_precision_widens(spark):
    from pyspark.errors import ArithmeticException
    from pyspark.errors.exceptions.captured import SparkRuntimeException

    df = spark.createDataFrame([(200000000.5,)], "v double")
    if spark.conf.get("spark.sql.ansi.enabled") == "true":
        with pytest.raises((ArithmeticException, SparkRuntimeException)):
            df.select(to_decimal("v")).collect()
    assert df.select(to_decimal("v", precision=12).alias("d")).first()["d"] == Decimal("200000000.50")
