"""Command line: python -m spotloom list | run NAME FOLDER OUT | explain NAME FOLDER. Queries are those of __spark_entry__."""

from __future__ import annotations

import argparse
import importlib

from spotloom.session import get_spark


def main(args: list[str] | None = None) -> int:
    """list prints the names of the queries; run writes a query's rows as parquet and prints their number; explain prints its plan."""
    parser = argparse.ArgumentParser(prog="spotloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries").add_argument("--part", default="", help="only names that contain this")
    for name, text in (("run", "run a query on a folder of tables"), ("explain", "the plan of a query")):
        c = commands.add_parser(name, help=text)
        c.add_argument("query")
        c.add_argument("folder", help="one parquet table per name, a file or a folder each")
        c.add_argument("--cpus", default="*", help="local threads where no cluster is given")
        if name == "run":
            c.add_argument("out", help="folder to write to; what is there is replaced")
    given = parser.parse_args(args)
    queries = importlib.import_module("__spark_entry__").queries()
    if given.command == "list":
        print(*sorted(q for q in queries if given.part in q), sep="\n")
        return 0
    if given.query not in queries:
        parser.error(f"no query is named {given.query}")
    spark = get_spark(given.cpus)
    df = queries[given.query](spark, given.folder)
    if given.command == "explain":
        df.explain("formatted")
        return 0
    df.write.mode("overwrite").parquet(given.out)
    print(spark.read.parquet(given.out).count(), "rows")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
