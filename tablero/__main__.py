"""Run one report over a folder of Parquet tables and write the result.

usage: python -m tablero REPORT TABLES_ROOT AS_OF OUTPUT [--tz ZONE] [--unordered]

TABLES_ROOT holds ``<table>.parquet`` (``webscraping/<table>.parquet`` for the
scraped listings); AS_OF is the report clock in UTC, e.g. "2024-02-15 12:00:00".
On a cluster, run it with spark-submit; the session's own settings are kept.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tablero import DEFAULT_TZ
from tablero.plans.reports import REPORTS, report
from tablero.session import configure
from tablero.sources import from_parquet, write_parquet


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m tablero")
    ap.add_argument("report", choices=sorted(REPORTS))
    ap.add_argument("tables_root")
    ap.add_argument("as_of")
    ap.add_argument("output")
    ap.add_argument("--tz", default=DEFAULT_TZ)
    ap.add_argument("--unordered", action="store_true", help="skip the final global sort")
    args = ap.parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"tablero-{args.report}").getOrCreate())
    df = report(args.report, from_parquet(spark, args.tables_root), args.as_of, tz=args.tz,
                ordered=not args.unordered)
    write_parquet(df, args.output)


if __name__ == "__main__":
    main()
