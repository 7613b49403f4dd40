"""Jobs from the command line: ``spark-submit`` this file or run ``python -m skyfold``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from skyfold.operators import gate
from skyfold.plans import (
    backfill_years,
    build_facts,
    built_tables,
    catch_up,
    check_sources,
    check_tables,
    ingest_dimensions,
    ingest_year,
    mark_built,
    pending_years,
    store_results,
)
from skyfold.plans.facts import VARIANTS
from skyfold.plans.jobs import new_run_id
from skyfold.session import open_session
from skyfold.sources import read_dimension


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="skyfold", description=__doc__)
    parser.add_argument("--input-bytes", type=int, default=0, help="sizes the shuffles")
    jobs = parser.add_subparsers(dest="job", required=True)

    one = jobs.add_parser("ingest-year", help="check, type and replace one year")
    one.add_argument("csv")
    one.add_argument("root")
    one.add_argument("year", type=int)
    one.add_argument("--results")
    one.add_argument("--least-percent", type=int, help="refuse a file with less than this share of the rows of the last passed run")

    many = jobs.add_parser("backfill", help="check, type and replace many years")
    many.add_argument("root")
    many.add_argument("csv", nargs="+")
    many.add_argument("--results")

    some = jobs.add_parser("catch-up", help="ingest the years that are missing or have changed, one at a time")
    for name in ("root", "ledger"):
        some.add_argument(name)
    some.add_argument("csv", nargs="+")
    some.add_argument("--results")

    dims = jobs.add_parser("ingest-dimensions", help="fixed-width stations and countries to tables")
    for name in ("stations_txt", "countries_txt", "stations", "countries"):
        dims.add_argument(name)

    facts = jobs.add_parser("build-facts", help="build the five facts of a year range")
    for name in ("root", "stations", "countries", "out"):
        facts.add_argument(name)
    facts.add_argument("first_year", type=int)
    facts.add_argument("last_year", type=int)
    facts.add_argument("--variant", choices=VARIANTS, default="exact")
    facts.add_argument("--changed-years", type=int, nargs="+")
    facts.add_argument("--ledger", help="refresh the years that this ledger of a catch-up holds as not built yet")
    facts.add_argument("--sample-rows", type=int, help="a trial build, into a folder of its own")
    facts.add_argument("--results")

    sources = jobs.add_parser("check-sources", help="run the declared checks over observations, stations and countries")
    for name in ("root", "stations", "countries"):
        sources.add_argument(name)
    sources.add_argument("--results", required=True)

    checks = jobs.add_parser("check-facts", help="run the declared checks over built facts")
    checks.add_argument("out")
    checks.add_argument("--variant", choices=VARIANTS, default="exact")
    checks.add_argument("--results", required=True)
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "ingest-year":
        ingest_year(spark, args.csv, args.root, args.year, args.results, least_percent=args.least_percent)
    elif args.job == "backfill":
        backfill_years(spark, args.csv, args.root, args.results)
    elif args.job == "catch-up":
        catch_up(spark, args.csv, args.root, args.ledger, args.results)
    elif args.job == "ingest-dimensions":
        ingest_dimensions(spark, args.stations_txt, args.countries_txt, args.stations, args.countries)
    elif args.job == "build-facts":
        changed, pending = args.changed_years, []
        if args.ledger:
            pending = pending_years(spark, args.ledger)
            # Without facts of this variant the build is a full one, which covers them.
            if built_tables(spark, args.out, args.variant).number:
                if not pending:
                    return
                changed = sorted({*(changed or []), *pending})
        build_facts(
            spark,
            args.root,
            read_dimension(spark, args.stations),
            read_dimension(spark, args.countries),
            args.out,
            args.first_year,
            args.last_year,
            args.variant,
            changed,
            args.sample_rows,
            args.results,
        )
        if args.ledger and args.sample_rows is None:
            mark_built(spark, args.ledger, pending)
    elif args.job == "check-sources":
        dimensions = read_dimension(spark, args.stations), read_dimension(spark, args.countries)
        found = check_sources(spark.read.parquet(args.root), *dimensions)
        gate(store_results(found, args.results, new_run_id()))
    else:
        gate(store_results(check_tables(spark, args.out, args.variant), args.results, new_run_id()))


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    run(open_session(f"skyfold {args.job}", args.input_bytes), args)


if __name__ == "__main__":
    main()
