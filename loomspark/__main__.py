"""Command line: ``python -m loomspark list``, ``run QUERY TABLES OUT``, ``merge OUT FOLDER...``, ``stats TABLES``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomspark")
    commands = p.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries")
    run = commands.add_parser("run", help="write a query's result")
    run.add_argument("query")
    run.add_argument("tables", help="folder of the Parquet tables")
    run.add_argument("out")
    run.add_argument("--format", choices=("parquet", "json", "csv"), default="parquet")
    merge = commands.add_parser("merge", help="merge record files of several folders, with their origin")
    merge.add_argument("out")
    merge.add_argument("folders", nargs="+")
    stats = commands.add_parser("stats", help="print statistics of the records")
    stats.add_argument("tables")
    return p


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from .plans.registry import QUERIES
    from .sources import inputs, records

    a = parser().parse_args(arguments)
    if a.command == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = spark or SparkSession.builder.appName("loomspark").getOrCreate()
    if a.command == "run":
        if a.query not in QUERIES:
            print(f"no query {a.query!r}")
            return 2
        records.write(QUERIES[a.query](spark, a.tables), a.out, a.format)
    elif a.command == "merge":
        rows = inputs.merged({f: records.read_files(spark, f) for f in a.folders})
        rows.selectExpr("origin", "source", "pos", "to_json(row) AS record").write.parquet(a.out)
    else:
        QUERIES["dataset_statistics"](spark, a.tables).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
