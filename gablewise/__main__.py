"""python -m gablewise list | run NAME TABLES OUT | explain NAME TABLES: the queries of the catalogue from the command line."""

from __future__ import annotations

import argparse

from gablewise.plans.catalogue import QUERIES
from gablewise.sources.files import publish


def main() -> None:
    p = argparse.ArgumentParser(prog="gablewise", description=__doc__)
    sub = p.add_subparsers(dest="what", required=True)
    sub.add_parser("list")
    for what in ("run", "explain"):
        q = sub.add_parser(what)
        q.add_argument("name", choices=sorted(QUERIES))
        q.add_argument("tables", help="folder of the tables")
        if what == "run":
            q.add_argument("out", help="path of the result, which replaces what is there once it is whole")
    a = p.parse_args()
    if a.what == "list":
        for name, f in sorted(QUERIES.items()):
            print(name, "-", (f.__doc__ or "").strip().split("\n")[0])
        return
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("gablewise").getOrCreate()
    df = QUERIES[a.name](spark, a.tables)
    if a.what == "explain":
        df.explain("formatted")
    else:
        print(publish(df, a.out), "rows")


if __name__ == "__main__":
    main()
