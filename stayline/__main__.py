"""Command line: build the tables, run a catalogued query or SQL text, show a customer, validate.

python -m stayline build    --data ORDERS_FOLDER --out STAR_FOLDER
python -m stayline query    --data STAR_FOLDER Q5        (or: all)
python -m stayline sql      --data STAR_FOLDER "SELECT ..."
python -m stayline customer --data STAR_FOLDER CUST000000000030 [--show-pii] [--out FOLDER]
python -m stayline validate --data STAR_FOLDER
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame

from stayline.operators import checks
from stayline.plans import catalog, view360
from stayline.plans.pipeline import Pipeline
from stayline.session import build_session
from stayline.sinks.writers import write_csv, write_document
from stayline.sources.projection import AS_OF, AfterSales
from stayline.sources.tables import load_all, register


def present(rows: DataFrame, args: argparse.Namespace, name: str) -> None:
    """All rows as CSV files under ``--out``, or the first ``--rows`` of them with whole texts."""
    if args.out:
        path = f"{args.out.rstrip('/')}/{name}.csv"
        write_csv(rows, path)
        print(path)
    else:
        rows.show(args.rows, truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="stayline")
    parser.add_argument("command", choices=["build", "query", "sql", "customer", "validate"])
    parser.add_argument("argument", nargs="?")
    parser.add_argument("--data", required=True)
    parser.add_argument("--out")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=AS_OF)
    parser.add_argument("--show-pii", action="store_true")
    parser.add_argument("--rows", type=int, default=50, help="rows to print; --out writes all of them as CSV")
    args = parser.parse_intermixed_args(argv)
    spark = build_session()

    if args.command == "build":
        Pipeline(spark, args.out, args.as_of).run(AfterSales(spark, args.data, args.as_of)).show()
        return
    tables, missing = load_all(spark, args.data, fmt=args.format)
    for name, reason in missing.items():
        print(f"not loaded: {name} ({reason})")
    if args.command == "query":
        chosen = catalog.CATALOG if args.argument in (None, "all") else [args.argument]
        for query_id in chosen:
            print(query_id)
            present(catalog.run(query_id, tables), args, query_id)
    elif args.command == "sql":
        register(tables)
        present(spark.sql(args.argument), args, "sql")
    elif args.command == "customer":
        view360.summary(tables, args.argument).show(20, truncate=False)
        rows = view360.document(tables, args.argument, args.show_pii)
        rows.show(args.rows, truncate=False)
        if args.out:
            print(write_document(rows, args.argument, args.out))
    else:
        report = checks.report(tables)
        report.where("violations > 0").show(50, truncate=False)
        checks.verdict(report).show()


if __name__ == "__main__":
    main()
