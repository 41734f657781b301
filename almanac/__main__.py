"""Run a job: python -m almanac retail|check|clean --source PATH --out PATH"""

from __future__ import annotations

import argparse

from almanac.functions.countries import default_countries, read_countries
from almanac.plans.jobs import retail_job
from almanac.session import build_session
from almanac.streaming.clean_zone import clean_arrivals
from almanac.streaming.file_checks import check_arrivals


def main() -> None:
    parser = argparse.ArgumentParser(prog="almanac", description=__doc__)
    parser.add_argument("job", choices=["retail", "check", "clean"])
    parser.add_argument("--source", required=True, help="raw file or folder")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--steps", default="all", help="retail: transform,daily,products,rfm or all")
    parser.add_argument("--offsets", help="check, clean: folder that remembers the files seen")
    parser.add_argument("--countries", help="clean: country table, CSV with header or Parquet")
    args = parser.parse_args()
    spark = build_session(f"almanac-{args.job}")
    offsets = args.offsets or f"{args.out.rstrip('/')}/_offsets"
    if args.job == "retail":
        retail_job(spark, args.source, args.out, args.steps.split(","))
    elif args.job == "check":
        check_arrivals(spark, args.source, args.out, offsets).awaitTermination()
    else:
        known = read_countries(spark, args.countries) if args.countries else default_countries(spark)
        clean_arrivals(spark, args.source, args.out, offsets, known).awaitTermination()


if __name__ == "__main__":
    main()
