"""Command-line entry for one layer step, or a whole ordered flow.

    spark-submit scripts/layers.py bronze --path /feeds/ --file customers.csv --schema analytics
    python -m tierline silver --file customers.csv --schema analytics
    python -m tierline gold --file customers.csv --schema analytics
    python -m tierline all --path /feeds/ --file customers_jan.csv --file customers_feb.csv --schema analytics
    python -m tierline monolith --path /feeds/customers/ --schema analytics
    python -m tierline bronze --path /feeds/ --file customers.csv --schema analytics --max-rejects 0.01
    python -m tierline mixed --path /feeds/ --schema analytics
    python -m tierline all --path /feeds/ --schema analytics --ledger /shared/ledger

Each call is one Spark application step whose hand-over to the next is the
stored table, so an external scheduler can run them as dependent tasks
(bronze -> silver per file; all silvers -> gold). ``all`` runs them in that
order on one session (with ``--ledger``, going on where an earlier call failed);
``monolith`` reads one folder with inferred types and builds its bronze, silver and
gold tables; ``mixed`` reads one folder with files of several feeds into their
bronze tables. With ``--max-rejects`` bronze puts lines that don't fit the feed aside
and refuses a load with a larger share of them.
"""

from __future__ import annotations

import argparse
import sys

from tierline.plans.flow import (
    Target,
    build_gold,
    build_monolith_gold,
    build_monolith_silver,
    build_silver,
    ingest_bronze,
    ingest_bronze_checked,
    ingest_mixed,
    ingest_monolith_bronze,
    run_layers,
)
from tierline.session import build_session
from tierline.specs import FEEDS


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tierline", description=__doc__.split("\n\n")[0])
    p.add_argument("step", choices=["bronze", "silver", "gold", "all", "monolith", "mixed"])
    p.add_argument("--path", default=None, help="folder holding the feed files (bronze, all, monolith, mixed)")
    p.add_argument("--file", action="append", help="feed file name; its name picks the schema and names the tables; repeat it for all")
    p.add_argument("--schema", required=True, help="database that holds the layer tables")
    p.add_argument("--catalog", default=None)
    p.add_argument("--format", default="parquet", dest="fmt")
    p.add_argument("--time-zone", default=None, help="session time zone for the stamps")
    p.add_argument("--precision", type=int, default=10, help="digits of gold averages; an average beyond them raises")
    p.add_argument("--initial-partitions", type=int, default=None, help="partitions that a shuffle starts with, about its size / 128 MB")
    p.add_argument("--max-rejects", type=float, default=None, help="bronze: put lines that don't fit aside, up to this share of them")
    p.add_argument("--ledger", default=None, help="all: shared folder of what is done, so a failed call is repeated from where it failed")
    return p


def main(argv: list[str] | None = None) -> dict[str, str]:
    args = _parser().parse_args(argv)
    spark = build_session(time_zone=args.time_zone, initial_partitions=args.initial_partitions)
    target = Target(database=args.schema, catalog=args.catalog, fmt=args.fmt).ensure(spark)
    folder = (args.path or "").rstrip("/")
    if args.step in ("bronze", "all", "monolith", "mixed") and not folder:
        raise SystemExit("--path is required for bronze, all, monolith and mixed")
    files = args.file or [f"{name}.csv" for name in FEEDS]
    if args.step == "all":
        return run_layers(spark, {f: f"{folder}/{f}" for f in files}, target, precision=args.precision, ledger=args.ledger)
    if args.step == "monolith":
        return {
            "bronze": ingest_monolith_bronze(spark, folder, target),
            "silver": build_monolith_silver(spark, target),
            "gold": build_monolith_gold(spark, target, args.precision),
        }
    if args.step == "mixed":
        return ingest_mixed(spark, folder, target)
    if args.step == "bronze" and args.max_rejects is not None:
        loaded = ingest_bronze_checked(spark, f"{folder}/{files[0]}", files[0], target, args.max_rejects)
        return {"bronze": loaded.table, "rejects": loaded.rejects}
    if args.step == "bronze":
        return {"bronze": ingest_bronze(spark, f"{folder}/{files[0]}", files[0], target)}
    if args.step == "silver":
        return {"silver": build_silver(spark, files[0], target)}
    return {"gold": build_gold(spark, target, files[0], args.precision)}


if __name__ == "__main__":
    for key, table in main(sys.argv[1:]).items():
        print(f"{key}\t{table}")
