"""python -m cabstrata COMMAND ...

ingest, load, drift: mirror, load and compare raw files. month, backfill: from raw files to published
tables (a month without --months is that of --interval-start, else today's less --lag-months). year: the
historical tables of a year. status: months whose marts are still to be built. swap, clone, vacuum,
drop-historical: tables. views, sql: what is published, for consumers. query: a query over test tables.

Exit codes: 0 done, 2 a test failed and nothing was published, 3 the month isn't published yet.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from cabstrata.plans import pipeline, registry
from cabstrata.session import local_session
from cabstrata.sources import bronze, files
from cabstrata.sources.months import parse_months, target_month
from cabstrata.sources.tables import Lake

COMMANDS = ["ingest", "load", "drift", "month", "backfill", "year", "status", "swap", "clone", "vacuum", "drop-historical", "views", "sql", "query"]
OK, FAILED, NOT_PUBLISHED = 0, 2, 3


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cabstrata", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("command", choices=COMMANDS)
    for name in ("lake", "origin", "mirror", "zones", "months", "first", "last", "year", "name", "data", "source", "target", "database"):
        p.add_argument(f"--{name}")
    p.add_argument("--force", action="store_true")
    p.add_argument("--tolerance", type=float, default=0.40)
    p.add_argument("--least", type=int, default=10_000)
    p.add_argument("--lag-months", type=int, default=2)
    p.add_argument("--interval-start", type=date.fromisoformat)
    return p


def month_of(a: argparse.Namespace, today: date) -> str:
    """The month of a run, as text."""
    asked = parse_months(a.months) if a.months else []
    if len(asked) > 1:
        raise ValueError("one month at a time; backfill takes a range")
    return str(target_month(today, *((asked[0].year, asked[0].month) if asked else (None, None)), interval_start=a.interval_start, lag_months=a.lag_months))


def main(argv: list[str] | None = None, spark=None) -> int:
    a = parser().parse_args(argv)
    spark = spark or local_session()
    if a.command == "query":
        registry.QUERIES[a.name](spark, a.data).show(100, False)
        return OK
    if a.command == "ingest":
        print(*files.ingest_missing(spark, parse_months(a.months), a.origin, a.mirror, a.force), sep="\n")
        return OK
    lake = Lake(spark, a.lake)
    if a.command == "load":
        pipeline.load_bronze(lake, [f"{a.mirror}/{m.filename}" for m in parse_months(a.months)])
    elif a.command == "drift":
        for m in parse_months(a.months):
            print(m, pipeline.detect_drift(lake, a.origin, m))
    elif a.command in ("month", "backfill"):
        m = month_of(a, date.today()) if a.command == "month" else ""
        try:
            got = pipeline.backfill(lake, a.origin, a.mirror, bronze.read_zones(spark, a.zones), a.first or m, a.last or m, tolerance=a.tolerance, least=a.least)
        except pipeline.ChecksFailed as e:
            print(e, file=sys.stderr)
            return FAILED
        print(got)
        return NOT_PUBLISHED if "not_published" in got.values() else OK
    elif a.command == "year":
        for path, reason in pipeline.run_year(lake, a.mirror, int(a.year)):
            print(f"skipped {path}: {reason}", file=sys.stderr)
    elif a.command == "swap":
        lake.swap(pipeline.PUBLISHED, pipeline.BUILD)
    elif a.command == "clone":
        lake.clone(a.source, a.target)
    elif a.command == "vacuum":
        print(*lake.vacuum(), sep="\n")
    elif a.command == "drop-historical":
        pipeline.drop_historical(lake)
    elif a.command == "views":
        for schema in (pipeline.PUBLISHED, pipeline.HISTORICAL):
            print(schema, *lake.register(schema, a.database or schema))
    elif a.command == "sql":
        for schema in (pipeline.PUBLISHED, pipeline.HISTORICAL):
            lake.publish_views(schema, f"{schema}_")
        spark.sql(a.name).show(100, False)
    else:
        pipeline.pending_rebuilds(lake).show(100, False)
    return OK


if __name__ == "__main__":
    sys.exit(main())
