"""Command line for a warehouse folder: python -m tillmetrics --help."""

from __future__ import annotations

import argparse
import datetime as dt
from pathlib import PurePath

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillmetrics.operators.dimensions import with_guest
from tillmetrics.plans import pipeline, views
from tillmetrics.session import prepare
from tillmetrics.settings import RETAIL
from tillmetrics.sources.export import export_csv
from tillmetrics.sources.files import read_file
from tillmetrics.sources.schemas import RAW
from tillmetrics.sources.warehouse import BATCH, Warehouse

GUEST_ID = 0


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tillmetrics")
    parser.add_argument("root", help="folder of the warehouse")
    commands = parser.add_subparsers(dest="command", required=True)

    load = commands.add_parser("dimensions", help="replace customers and products")
    load.add_argument("customers")
    load.add_argument("products")
    load.add_argument("--since", type=dt.date.fromisoformat, required=True, help="guest signup day")

    land = commands.add_parser("land", help="store a department export unchanged")
    land.add_argument("table", choices=list(RAW))
    land.add_argument("file")
    land.add_argument("--day", type=dt.date.fromisoformat, required=True, help="batch day")
    land.add_argument("--delivery", help="a delivery replaces itself; by default the file's name")

    for command in (load, land):
        command.add_argument("--kind", choices=("csv", "parquet"), default="csv")

    refresh = commands.add_parser("refresh", help="rebuild everything from the landed exports")
    refresh.add_argument("first", type=dt.date.fromisoformat)
    refresh.add_argument("last", type=dt.date.fromisoformat)

    append = commands.add_parser("append", help="append every missing full day")
    append.add_argument("--today", type=dt.date.fromisoformat, default=None)
    append.add_argument("--since", type=dt.date.fromisoformat, default=None)

    query = commands.add_parser("sql", help="query tables and views")
    query.add_argument("statement")

    export = commands.add_parser("export", help="write all tables and views as CSV")
    export.add_argument("folder")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = prepare(SparkSession.builder.appName("tillmetrics").getOrCreate())
    warehouse = Warehouse(spark, args.root)
    if args.command == "dimensions":
        people = read_file(spark, "dim_customers", args.customers, args.kind)
        goods = read_file(spark, "dim_products", args.products, args.kind)
        everyone = with_guest(people, GUEST_ID, RETAIL.guest_email, args.since)
        pipeline.load_dimensions(warehouse, everyone, goods)
    elif args.command == "land":
        rows = read_file(spark, args.table, args.file, args.kind)
        name = args.delivery or PurePath(args.file).name
        warehouse.land(args.table, rows.withColumn(BATCH, F.lit(args.day)), delivery=name)
    elif args.command == "refresh":
        pipeline.full_refresh(warehouse, args.first, args.last, RETAIL)
    elif args.command == "append":
        today = args.today or dt.date.today()
        for day in pipeline.append_missing(warehouse, today, RETAIL, args.since):
            print(day)
    elif args.command == "sql":
        views.publish_views({**warehouse.star(), **warehouse.raw(), **warehouse.reports()})
        found = spark.sql(args.statement)
        print("\t".join(found.columns))
        for row in found.toLocalIterator():
            print("\t".join("" if value is None else str(value) for value in row))
    elif args.command == "export":
        tables = {**warehouse.star(), **warehouse.raw()}
        for path in export_csv({**tables, **views.views(tables)}, args.folder).values():
            print(path)


if __name__ == "__main__":
    main()
