"""Silver -> gold aggregates, the validation join and the window totals.

Scale notes (a key may hold a third of all rows):

* Grouped aggregates use Spark's partial + final aggregation, so a hot key
  costs one combined row per map task, not its raw rows.
* Nothing partitions **raw** rows by the member key for a window. The
  window form first collapses rows to one row per (key, band), so a window
  group holds at most one row per band.
* Where two aggregates need the same combined input (the validation join),
  it is written once to the shared folder instead of computed twice.
* The per-row window form (:func:`with_key_totals`) aggregates per key and
  joins back; the join is left to the planner, which broadcasts only when the
  measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
  otherwise uses a shuffle join whose hot partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions.columns import stamp, to_decimal
from tierline.session import stored
from tierline.sources.feeds import INGESTED_AT

# Output names shared by every gold form.
KEY = "member_id"
NAME = "first_name"
COUNT = "participations"
TOTAL = "total_points"
AVG = "avg_points"
MIN = "min_points"
MAX = "max_points"
BAND = "band"


def per_key_totals(df: DataFrame, key: str = "UUID", points: str = "points_int") -> DataFrame:
    """One row per key: double average, sum, min, max, ``count(key)``.

    ``count(key)`` skips NULL keys, so the NULL-key group reports 0 while its
    sum is real; an all-NULL group has NULL sum/avg/min/max.
    """
    p = F.col(points)
    return df.groupBy(key).agg(
        F.avg(p).alias(AVG),
        F.sum(p).alias(TOTAL),
        F.min(p).alias(MIN),
        F.max(p).alias(MAX),
        F.count(F.col(key)).alias(COUNT),
    ).withColumnRenamed(key, KEY)


def _stats(df: DataFrame, groups: list[str], key: str, points: str, name: str | None = None) -> DataFrame:
    """Combinable statistics at ``groups`` (+ ``name``) grain.

    Only fixed-width buffers (counts, sums, min, max), so Spark plans a hash
    aggregate with map-side combine. A string ``max`` would force a sort of
    every raw row instead; the name is therefore a grouping key here and its
    maximum is taken later over these few combined rows (:func:`_merged`).
    """
    p = F.col(points)
    by = [*groups, name] if name else list(groups)
    return df.groupBy(*by).agg(
        F.count(F.col(key)).alias("_n_key"),
        F.sum(p).alias("_sum"),
        F.count(p).alias("_n_pts"),
        F.min(p).alias("_min"),
        F.max(p).alias("_max"),
    )


def _merged(stats: DataFrame, groups: list[str], name: str | None = None) -> DataFrame:
    """Merge :func:`_stats` rows to ``groups`` grain (and the max name)."""
    aggs = [
        F.sum("_n_key").alias("_n_key"),
        F.sum("_sum").alias("_sum"),
        F.sum("_n_pts").alias("_n_pts"),
        F.min("_min").alias("_min"),
        F.max("_max").alias("_max"),
    ]
    if name:
        aggs.insert(0, F.max(name).alias("_name"))
    return stats.groupBy(*groups).agg(*aggs)


def _avg(total: Column | str, n: Column | str) -> Column:
    """``sum / count`` in double (what AVG of an int computes); NULL on 0 rows."""
    return F.try_divide(total, n)


def _key_band(silver: DataFrame, key: str, name: str, points: str, band: str) -> DataFrame:
    """Statistics and max name at (key, band) grain, one row per group."""
    return _merged(_stats(silver, [key, band], key, points, name), [key, band], name)


#: Bytes of a name that one decimal(38) holds in order, with room for a mark below them.
HEAD = 14
_HALF = 1 << 57  # seven bytes and the mark


def _name_code(name: str) -> Column:
    """A name as a number of the same order: its first ``HEAD`` bytes, and a mark if that isn't all of it.

    A decimal has a place of its own in a hash aggregate's buffer, which a string hasn't.
    """
    raw = F.hex(F.encode(F.col(name), "UTF-8"))
    head = F.rpad(F.substring(raw, 1, 2 * HEAD), 2 * HEAD, "0")
    high, low = (F.conv(F.substring(head, 1 + HEAD * i, HEAD), 16, 10).cast("bigint") for i in (0, 1))
    # a zero byte in a name would look like its end
    more = ((F.octet_length(name) > HEAD) | F.contains(F.col(name), F.lit("\x00"))).cast("int")
    return high.cast("decimal(19,0)") * F.lit(_HALF).cast("decimal(18,0)") + (low.cast("decimal(19,0)") * 2 + more)


def _name_of_code(code: Column) -> Column:
    """The name of an unmarked code."""
    half = F.lit(_HALF).cast("decimal(18,0)")
    rest = code % half
    high, low = ((code - rest) / half).cast("bigint"), F.shiftright(rest.cast("bigint"), 1)
    text = F.concat(*[F.lpad(F.hex(x), HEAD, "0") for x in (high, low)])
    return F.decode(F.unhex(F.regexp_replace(text, "(00)+$", "")), "UTF-8")


def key_band_of_many_names(silver: DataFrame, key: str = KEY, name: str = NAME, points: str = "points", band: str = BAND) -> DataFrame:
    """:func:`_key_band` for keys that may have nearly as many names as rows.

    Grouping by the name as well sends a row for each name of a key. Here names
    become numbers of the same order, whose maximum a hash aggregate keeps by
    key and band, so what is shuffled doesn't grow with the names. Only where
    the largest number stands for longer names than it holds are those rows
    read again, and the largest name taken among them alone.
    """
    coded = silver.withColumn("_code", _name_code(name))
    p = F.col(points)
    stats = stored(coded.groupBy(key, band).agg(
        F.max("_code").alias("_code"), F.count(F.col(key)).alias("_n_key"), F.sum(p).alias("_sum"), F.count(p).alias("_n_pts"),
        F.min(p).alias("_min"), F.max(p).alias("_max"),
    ), "names")
    cut = stats.where(F.col("_code") % 2 == 1).select(F.col(key).alias("_key"), F.col(band).alias("_band"), F.col("_code").alias("_most"))
    rows = coded.where(F.col("_code") % 2 == 1).select(key, band, name, "_code")
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(band).eqNullSafe(F.col("_band")) & (F.col("_code") == F.col("_most"))
    # the largest of the names that begin alike, by groups of their own first, as in _stats
    names = rows.join(cut, same).groupBy(key, band, name).agg(F.count(F.lit(1)).alias("_c"))
    names = names.groupBy(F.col(key).alias("_key"), F.col(band).alias("_band")).agg(F.max(name).alias("_long"))
    out = stats.join(names, F.col(key).eqNullSafe(F.col("_key")) & F.col(band).eqNullSafe(F.col("_band")), "left")
    whole = F.when(F.col("_code") % 2 == 0, _name_of_code(F.col("_code"))).otherwise(F.col("_long"))
    return out.select(key, band, whole.alias("_name"), "_n_key", "_sum", "_n_pts", "_min", "_max")


def gold_by_key_and_band(
    silver: DataFrame,
    key: str = KEY,
    name: str = NAME,
    points: str = "points",
    band: str = BAND,
    precision: int = 10,
    with_stamp: bool = True,
    many_names: bool = False,
) -> DataFrame:
    """Customers gold at (key, band) grain: max name, count(key), sum,
    decimal average, min, max, band and a stamp.

    Plan: hash aggregate at (key, band, name) with map-side combine, then a
    small merge to (key, band) that also takes the max name. With ``many_names``
    nothing is grouped by the name (:func:`key_band_of_many_names`).
    """
    m = (key_band_of_many_names if many_names else _key_band)(silver, key, name, points, band)
    cols: list[Column | str] = [
        F.col(key).alias(KEY),
        F.col("_name").alias(NAME),
        F.col("_n_key").alias(COUNT),
        F.col("_sum").alias(TOTAL),
        to_decimal(_avg("_sum", "_n_pts"), precision).alias(AVG),
        F.col("_min").alias(MIN),
        F.col("_max").alias(MAX),
        F.col(band).alias(BAND),
    ]
    if with_stamp:
        cols.append(stamp().alias(INGESTED_AT))
    return m.select(*cols)


def window_totals(
    silver: DataFrame,
    key: str = "UUID",
    name: str = "first_name_split",
    points: str = "points_int",
    band: str = BAND,
    precision: int = 10,
) -> DataFrame:
    """One row per (key, band) carrying **key-wide** totals.

    Same result as six ``agg(..) OVER (PARTITION BY key)`` columns over the
    raw rows, band kept, then DISTINCT. Here raw rows are first combined to
    one row per (key, band) (hash partials, then the max name over those), so
    the window holds at most one row per band for any key, however hot.
    """
    return _window_of(_key_band(silver, key, name, points, band), key, band, precision)


def _window_of(kb: DataFrame, key: str, band: str, precision: int) -> DataFrame:
    w = Window.partitionBy(key)
    total = F.sum("_sum").over(w)
    return kb.select(
        F.col(key).alias(KEY),
        F.max("_name").over(w).alias(NAME),
        F.sum("_n_key").over(w).alias(COUNT),
        total.alias(TOTAL),
        to_decimal(_avg(total, F.sum("_n_pts").over(w)), precision).alias(AVG),
        F.min("_min").over(w).alias(MIN),
        F.max("_max").over(w).alias(MAX),
        F.col(band).alias(BAND),
    )


def partials(
    silver: DataFrame,
    key: str = "UUID",
    name: str = "first_name_split",
    points: str = "points_int",
    band: str = BAND,
) -> DataFrame:
    """What the totals of these rows are made of, one row per (key, band).

    Sums, counts, minima and maxima only, so the partials of any parts of a
    table, put together, give its totals (:func:`window_totals_of`) without its
    rows. A key has at most one row per band in each part.
    """
    return _key_band(silver, key, name, points, band).select(F.col(key).alias(KEY), F.col(band).alias(BAND), "_name", "_n_key", "_sum", "_n_pts", "_min", "_max")


def window_totals_of(parts: DataFrame, precision: int = 10) -> DataFrame:
    """:func:`window_totals` from stored :func:`partials` of all parts of a table."""
    merged = _merged(parts.withColumnRenamed("_name", "_part_name"), [KEY, BAND], "_part_name")
    return _window_of(merged, KEY, BAND, precision)


def validation_report(
    silver: DataFrame,
    key: str = "UUID",
    name: str = "first_name_split",
    points: str = "points_int",
    band: str = BAND,
    ordered: bool = True,
) -> DataFrame:
    """Silver groups LEFT JOIN per-key totals, one row per (key, name, band).

    Same result as joining every silver row to the per-key view (LEFT JOIN on
    the key) and grouping by all non-aggregate columns: inside a group the
    per-key values are constant, and a NULL key has no partner, so all of its
    totals (count included) are NULL.

    Plan: raw rows are combined once to (key, name, band) statistics and
    written to the shared folder (the job runs when the report is built); the
    per-key totals are aggregated from that copy and LEFT-joined back to it. The input is scanned once (two
    aggregates over one source would otherwise each scan it, as column pruning
    makes them different plans), and no key's rows have to meet in one task:
    the planner broadcasts the totals only when their measured size is under
    the broadcast threshold, otherwise AQE splits a hot key's partition of the
    group side. Sorted by the count (ties by key, name, band) when ``ordered``.
    """
    pre = stored(_stats(silver, [key, name, band], key, points), "validation")
    totals = _merged(pre, [key]).select(
        F.col(key).alias("_key"),
        F.col("_n_key").alias(COUNT),
        F.col("_sum").alias(TOTAL),
        _avg("_sum", "_n_pts").alias(AVG),
        F.col("_max").alias(MAX),
        F.col("_min").alias(MIN),
    )
    out = pre.join(totals, pre[key] == totals["_key"], "left").select(
        F.col(key).alias(KEY),
        F.col(name).alias(NAME),
        COUNT,
        TOTAL,
        AVG,
        MAX,
        MIN,
        F.col(band).alias(BAND),
    )
    return sort_desc(out, COUNT, KEY, NAME, BAND) if ordered else out


def with_key_totals(
    df: DataFrame,
    key: str = "UUID",
    name: str = "first_name_split",
    points: str = "points_int",
    precision: int = 10,
) -> DataFrame:
    """Every row with its key's max name, count, sum, decimal average, min, max.

    The per-row result of ``agg(..) OVER (PARTITION BY key)`` with an
    unbounded frame, computed as a per-key aggregate joined back on the key
    with NULL-safe equality (NULL keys form one partition, as in a window).
    A window would hold a hot key's raw rows in one task; this keeps raw rows
    out of any single-task buffer. Every row has its partner, so a left join
    gives the same rows, and can only ever build from the totals.
    """
    totals = _merged(_stats(df, [key], key, points, name), [key], name).select(
        F.col(key).alias("_key"),
        F.col("_name").alias("key_" + NAME),
        F.col("_n_key").alias("key_" + COUNT),
        F.col("_sum").alias("key_" + TOTAL),
        to_decimal(_avg("_sum", "_n_pts"), precision).alias("key_" + AVG),
        F.col("_min").alias("key_" + MIN),
        F.col("_max").alias("key_" + MAX),
    )
    rows, per_key = df.alias("r"), totals.alias("k")
    joined = rows.join(per_key, F.col(f"r.`{key}`").eqNullSafe(F.col("k._key")), "left")
    return joined.select("r.*", *[F.col(f"k.`{c}`") for c in totals.columns if c != "_key"])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct raw values of one column (map-side de-duplicated)."""
    return df.select(column).distinct()


def group_by_all_sql(spark: SparkSession, view: str, key: str = "UUID", name: str = "first_name_split",
                     points: str = "points_int", band: str = BAND) -> DataFrame:
    """``GROUP BY ALL``: the grouping keys are every non-aggregate output."""
    return spark.sql(
        f"""
        SELECT `{key}` AS {KEY}, `{name}` AS {NAME}, `{band}` AS {BAND},
               COUNT(`{key}`) AS {COUNT}, SUM(`{points}`) AS {TOTAL}
        FROM {view}
        GROUP BY ALL
        """
    )


def sort_desc(df: DataFrame, column: str, *tiebreak: str) -> DataFrame:
    """Total order on ``column`` descending (NULLs last), ties by ``tiebreak``.

    The sort range-partitions on the whole sort key; without tie-breaking
    columns every row sharing a popular value would fall into one range
    partition (one task).
    """
    return df.orderBy(F.col(column).desc(), *[F.col(c).asc() for c in tiebreak])
