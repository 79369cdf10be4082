"""Shipped plans against the direct forms they replace, on an expanded input.

Usage: python scripts/scale_check.py [--copies 50] [--partitions 16] [--shuffle-partitions 16] [--hot] [--sf-dir DIR]

Expands the participation feed ``--copies`` times (each copy gets its own key
suffix), spreads it over ``--partitions`` cached partitions and, with
``--hot``, moves a third of all rows onto one key. Times each operator in its
shipped form and in the direct form (the test oracles in tests/test_gold.py)
through the ``noop`` sink, best of 2, and prints one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--copies", type=int, default=50)
    ap.add_argument("--partitions", type=int, default=16)
    ap.add_argument("--shuffle-partitions", type=int, default=16)
    ap.add_argument("--hot", action="store_true")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    args = ap.parse_args()

    from pyspark.sql import functions as F

    from test_gold import direct_key_totals, direct_validation, direct_window_totals
    from tierline.operators import gold as G
    from tierline.operators.silver import silver_customers, silver_monolith
    from tierline.session import build_session
    from tierline.sources.derived import participation

    spark = build_session("local[8]", shuffle_partitions=args.shuffle_partitions)
    spark.sparkContext.setLogLevel("ERROR")
    rep = F.explode(F.sequence(F.lit(1), F.lit(args.copies)))
    big = participation(spark, args.sf_dir).withColumn("rep", rep)
    key = F.concat_ws("-", "UUID", (F.col("rep") % 7).cast("string"))
    if args.hot:
        key = F.when(F.xxhash64("Name", "Points", "rep") % 3 == 0, F.lit("hot")).otherwise(key)
    big = big.withColumn("UUID", key).drop("rep").repartition(args.partitions).cache()
    rows = big.count()

    def best(make, n=2):
        times = []
        for _ in range(n):
            t = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        return round(min(times), 3)

    mono = lambda: silver_monolith(big)
    cust = lambda: silver_customers(big, with_stamp=False)
    triple = lambda: mono().select("UUID", "first_name_split", "points_int")

    def gold_single():
        s = cust()
        return s.groupBy("member_id", "band").agg(
            F.max("first_name"), F.count("member_id"), F.sum("points"),
            F.avg("points").cast("decimal(10,2)"), F.min("points"), F.max("points"))

    result = {
        "gold_by_key_and_band": [best(lambda: G.gold_by_key_and_band(cust(), with_stamp=False)), best(gold_single)],
        "window_totals": [best(lambda: G.window_totals(mono())), best(lambda: direct_window_totals(mono()))],
        "validation_report": [best(lambda: G.validation_report(mono(), ordered=False)),
                              best(lambda: direct_validation(spark, mono()))],
        "per_row_key_totals": [best(lambda: G.with_key_totals(triple())), best(lambda: direct_key_totals(triple()))],
    }
    spark.stop()
    print(json.dumps({"rows": rows, "partitions": args.partitions, "hot_key": args.hot,
                      "shipped_vs_direct_sec": result}))


if __name__ == "__main__":
    main()
