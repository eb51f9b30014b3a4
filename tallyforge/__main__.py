"""`python -m tallyforge` lists the queries; with a name and a folder of tables it shows what one returns."""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import SparkSession

from tallyforge.plans import catalog


def main() -> None:
    for plan in ("entities", "ladders", "outcomes", "quality", "release", "shadow", "text_queries", "usage"):
        import_module(f"tallyforge.plans.{plan}")
    parser = argparse.ArgumentParser(prog="tallyforge", description=__doc__)
    parser.add_argument("query", nargs="?", choices=sorted(catalog.QUERIES))
    parser.add_argument("tables", nargs="?", help="folder of <table>.parquet")
    parser.add_argument("--out", help="write the result there as Parquet instead of showing it; fails if something is there")
    args = parser.parse_args()
    if not args.query or not args.tables:
        print("\n".join(sorted(catalog.QUERIES)))
        return
    found = catalog.QUERIES[args.query](SparkSession.builder.getOrCreate(), args.tables)
    if args.out:
        found.write.mode("errorifexists").parquet(args.out)
    else:
        found.show(50, truncate=False)


if __name__ == "__main__":
    main()
