"""Command line: fetch, build, validate, report, national, charts and map over folders of snapshots and published tables."""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import functions as F

from siteweave.operators import analytics
from siteweave.plans import build as plan, figures
from siteweave.session import build_session
from siteweave.sinks import writers
from siteweave.sources import fetch
from siteweave.sources.http import CachedClient
from siteweave.sources.tables import read_published


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="siteweave")
    verbs = parser.add_subparsers(dest="verb", required=True)
    pull = verbs.add_parser("fetch", help="snapshots of the public interfaces to raw folders")
    pull.add_argument("folder", help="raw folder")
    pull.add_argument("--state", action="append", help="only these jurisdictions")
    pull.add_argument("--day", default=str(date.today()))
    for verb, help_ in (("build", "raw snapshots to published tables, all jurisdictions in one run"), ("validate", "contracts on published tables"), ("report", "largest operators and coverage"), ("national", "summary, totals and description of all jurisdictions"), ("charts", "the tables behind the figures"), ("map", "the points of the map")):
        sub = verbs.add_parser(verb, help=help_)
        sub.add_argument("folder", help="published tables" if verb != "build" else "folder for the published tables")
        if verb == "build":
            sub.add_argument("--raw", required=True)
            sub.add_argument("--state", action="append", help="only these jurisdictions")
        sub.add_argument("--master")
    args = parser.parse_args(argv)
    known = [code for code, *_ in plan.vocabulary.JURISDICTIONS]
    wanted = [s.upper() for s in getattr(args, "state", None) or []]
    if set(wanted) - set(known):
        parser.error(f"unknown jurisdiction: {', '.join(sorted(set(wanted) - set(known)))}")
    if args.verb == "fetch":
        client = CachedClient(f"{args.folder}/.cache")
        fetch.fetch_elements(client, args.folder, wanted or known, args.day)
        fetch.fetch_registry(client, args.folder, args.day)
        return 0
    spark = build_session(master=args.master)
    if args.verb == "build":
        records, inventory = plan.read_raw(spark, args.raw)
        if wanted:
            records = plan.placed(records).where(F.col("state").isin(*wanted))
        built = plan.build(records, inventory, **plan.read_evidence(spark, args.raw))
        plan.write_all(built, args.folder)
        built.summary.show(60, truncate=False)
        return 0
    facilities = read_published(spark, f"{args.folder}/facilities.parquet")
    if args.verb == "validate":
        found = plan.check(facilities, read_published(spark, f"{args.folder}/power_estimates.parquet")).where(F.col("violations") > 0)
        found.show(truncate=False)
        return int(not found.isEmpty())
    if args.verb == "report":
        analytics.top_operators(facilities, 12).show(truncate=False)
        analytics.load_by(facilities, "utility", 6).show(truncate=False)
        analytics.completeness(facilities).show(truncate=False)
        return 0
    if args.verb in ("charts", "map"):
        found = figures.all_figures(facilities, read_published(spark, f"{args.folder}/power_estimates.parquet"))
        for name, df in found.items():
            if (name == "map_points") == (args.verb == "map"):
                writers.write_table(df, f"{args.folder}/figures", name)
        return 0
    summary, totals = plan.write_national(facilities, args.folder)
    summary.show(60, truncate=False)
    totals.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
