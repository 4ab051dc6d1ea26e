"""Launcher: `spark-submit -m tierflow` style entry for the four jobs.

    python -m tierflow bronze --ingest readings --conf /conf [--start 2024-01-01 --end 2024-02-01]
    python -m tierflow silver --ingest readings --conf /conf --table-type event
           [--scope partition] [--keep-copies] [--evolve] [--index]
    python -m tierflow silver --ingest nodes --conf /conf --table-type dimension [--key id --latest-by changed]
    python -m tierflow gold   --ingest readings --conf /conf [--month 2024-01-15] [--aggregate vp1=avg ...]

`--conf` holds environment.json, ingestion/<ingest>.json and connectors/<name>.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tierflow.plans import bronze_to_silver, silver_to_gold, source_to_bronze
from tierflow.sources import load_spec


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    if bool(args.start) != bool(args.end):
        raise SystemExit("a back-fill needs both --start and --end")
    if bool(args.key) != bool(args.latest_by):
        raise SystemExit("latest rows need both --key and --latest-by")
    spark = SparkSession.builder.appName(f"tierflow-{args.job}-{args.ingest}").getOrCreate()
    conf = args.conf.rstrip("/")
    spec = load_spec(spark, args.ingest, f"{conf}/environment.json", f"{conf}/ingestion", f"{conf}/connectors")
    if args.job == "bronze":
        source_to_bronze(spark, spec, (args.start, args.end) if args.start else None)
    elif args.job == "silver":
        events = {"scope": args.scope, "dedupe_batch": not args.keep_copies, "evolve": args.evolve, "index": args.index}
        latest = {"key": args.key, "latest_by": args.latest_by}
        bronze_to_silver(spark, spec, args.table_type, **(events if args.table_type == "event" else latest))
    else:
        silver_to_gold(spark, spec, args.name, args.month, dict(pair.split("=", 1) for pair in args.aggregate))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tierflow")
    p.add_argument("job", choices=["bronze", "silver", "gold"])
    p.add_argument("--ingest", required=True)
    p.add_argument("--conf", required=True)
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--table-type", default="event", choices=["event", "dimension"])
    p.add_argument("--scope", default="table", choices=["table", "partition"])
    p.add_argument("--keep-copies", action="store_true")
    p.add_argument("--evolve", action="store_true")
    p.add_argument("--index", action="store_true")
    p.add_argument("--key")
    p.add_argument("--latest-by")
    p.add_argument("--name", default="wide_hourly")
    p.add_argument("--month")
    p.add_argument("--aggregate", action="append", default=[], metavar="MEASURE=NAME")
    return p


if __name__ == "__main__":
    main()
