"""Command line: ``python -m tallyloom generate|ingest|audit|check-payments|report-sales``."""

from __future__ import annotations

import argparse

from tallyloom import jobs
from tallyloom.session import get_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallyloom")
    commands = parser.add_subparsers(dest="command", required=True)

    make = commands.add_parser("generate", help="write the five tables as CSV")
    make.add_argument("out")
    make.add_argument("--customers", type=int, default=100)
    make.add_argument("--products", type=int, default=50)
    make.add_argument("--orders", type=int, default=200)
    make.add_argument("--least-items", type=int, default=1)
    make.add_argument("--most-items", type=int, default=5)

    load = commands.add_parser("ingest", help="load CSV files into the warehouse")
    load.add_argument("csv_root")
    load.add_argument("root")
    load.add_argument("--quarantine", action="store_true", help="set bad rows aside instead of failing")
    load.add_argument("--whole-files", action="store_true", help="read every file in one task")
    load.add_argument("--buckets", type=int, help="key buckets a table; more than it has deals it anew")

    for name in ("audit", "check-payments", "report-sales"):
        reading = commands.add_parser(name)
        reading.add_argument("root")
        reading.add_argument("out")

    args = parser.parse_args()
    spark = get_session(f"tallyloom {args.command}")
    if args.command == "generate":
        rows = jobs.generate_csv(
            spark, args.out, args.customers, args.products, args.orders, args.least_items, args.most_items
        )
    elif args.command == "ingest":
        rows = jobs.ingest(
            spark, args.csv_root, args.root, args.quarantine, args.whole_files, buckets=args.buckets
        )
    else:
        job = {"audit": jobs.audit, "check-payments": jobs.check_payments, "report-sales": jobs.report_sales}
        job[args.command](spark, args.root, args.out)
        rows = {}
    for table, count in rows.items():
        print(f"{table}: {count} rows")
    spark.stop()


if __name__ == "__main__":
    main()
