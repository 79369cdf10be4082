"""Inferred types without a second pass over the input.

The lines are landed as text, and the same write job notes for every column which
kinds of values it holds. A view over the landed table then gives each column the
type that reading with ``inferSchema`` would have chosen.
"""

from __future__ import annotations

from pyspark.sql import Column, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierline.functions.columns import stamp
from tierline.operators.sinks import DEFAULT_FORMAT, overwrite_table, quoted
from tierline.sources.feeds import INGESTED_AT, preview_feed, provenance

KINDS = ("int", "bigint", "decimal", "double", "date", "timestamp", "boolean", "string")
_NUMBER = r"^\s*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?)\s*$"


def kind_of(value: Column) -> Column:
    """Place in ``KINDS`` of the narrowest kind that a text value is of; NULL for NULL."""
    whole = value.rlike("^[+-]?[0-9]+$")
    digits = F.length(F.regexp_replace(value, "^[+-]", ""))
    tests = (
        whole & value.try_cast("int").isNotNull(),
        whole & value.try_cast("bigint").isNotNull(),
        whole & (digits <= 38),
        value.rlike(_NUMBER) | value.isin("Inf", "-Inf"),
        value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(),
        value.try_cast("timestamp").isNotNull(),
        F.lower(value).isin("true", "false"),
    )
    out = F.lit(len(tests))
    for i in reversed(range(len(tests))):
        out = F.when(tests[i], F.lit(i)).otherwise(out)
    return F.when(value.isNotNull(), out)


def type_for(kinds: set[str], digits: int = 0) -> str:
    """The type that holds values of all these kinds; text if none does."""
    if not kinds:
        return "string"
    if kinds <= {"int", "bigint", "decimal", "double"}:
        if "double" in kinds:
            return "double"
        if "decimal" in kinds:
            return f"decimal({max(digits, 20 if 'bigint' in kinds else 10)},0)"
        return "bigint" if "bigint" in kinds else "int"
    if kinds <= {"date", "timestamp"}:
        return "timestamp" if "timestamp" in kinds else "date"
    return "boolean" if kinds == {"boolean"} else "string"


def land_inferred(spark: SparkSession, path: str, table: str, landed: str, sep: str = ";", fmt: str = DEFAULT_FORMAT) -> dict[str, str]:
    """Land a folder of delimited files as text in ``landed`` and make ``table`` a view of it
    with header names and inferred types, file name and stamp; returns the types.

    One scan of the input (the header apart) and one narrow write job, whose
    observed metrics hold the kinds. Types are those of ``inferSchema``, but
    don't depend on the order of the lines: a column that has numbers and times is text, and a
    hexadecimal number is text. Casts run when the view is read; each value fits by
    construction. ``table`` must be missing or a view.
    """
    names = preview_feed(spark, path, sep).columns
    schema = StructType([StructField(n, StringType()) for n in names])
    lines = spark.read.schema(schema).options(sep=sep, header="true").csv(path)
    told = [F.bit_or(F.expr(f"shiftleft(1, _kind{i})")).alias(f"k{i}") for i in range(len(names))]
    seen = Observation()
    kinds = {f"_kind{i}": kind_of(F.col(quoted(n))) for i, n in enumerate(names)}
    longest = [F.max(F.when(F.col(f"_kind{i}") <= 2, F.length(F.regexp_replace(F.col(quoted(n)), "^[+-]", "")))).alias(f"d{i}") for i, n in enumerate(names)]
    df = lines.select("*", *provenance(), stamp().alias(INGESTED_AT)).withColumns(kinds).observe(seen, F.count(F.lit(1)).alias("n"), *told, *longest).drop(*kinds)
    overwrite_table(df, landed, fmt)
    got = seen.get
    types = {n: type_for({k for j, k in enumerate(KINDS) if (got[f"k{i}"] or 0) >> j & 1}, got[f"d{i}"] or 0) for i, n in enumerate(names)}
    casts = [f"CAST({quoted(n)} AS {t}) AS {quoted(n)}" for n, t in types.items()]
    rest = [quoted(c) for c in df.columns if c not in names]
    how = "ALTER VIEW" if spark.catalog.tableExists(table) else "CREATE VIEW"  # never absent
    spark.sql(f"{how} {table} AS SELECT {', '.join([*casts, *rest])} FROM {landed}")
    return types
