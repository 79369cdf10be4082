from __future__ import annotations

import sys

import pytest
from core_helpers import ROOT

sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("tierline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Edge fixture (FIXTURES.md section 4): bounds 999/1000/2000/2001, invalid,
# fractional, NULL and overflowing points, NULL key, '' name, leading blank, '_'.
EDGE_ROWS = [
    ("u1", "Ana_Souza x", "999"),
    ("u1", "Ana_Souza x", "1000"),
    ("u1", "Ana_Souza x", "abc"),
    ("u2", "bob lee", "2000"),
    ("u2", "bob lee", "2001"),
    ("u3", None, "12.5"),
    ("u4", "", None),
    ("u5", " lead", " 7 "),
    (None, "NoId", "10"),
    ("u6", "_x y", "-3"),
    ("u6", "plain", "99999999999"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, "UUID string, Name string, Points string")

