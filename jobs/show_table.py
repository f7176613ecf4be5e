"""spark-submit jobs/show_table.py <table>: schema, row count and 20 rows, of all rows or those of --where or --key."""

from __future__ import annotations

from jobs.common import parser, run
from tidemark.sources import TableStore


def main(argv, spark) -> None:
    args = parser(__doc__, "table")
    args.add_argument("--where", help="predicate, e.g. 'ProductID = 680'")
    args.add_argument("--key", action="append", default=[], metavar="COLUMN=VALUE", help="one key; reads its part alone")
    options = args.parse_args(argv)
    store = TableStore(spark)
    values = dict(pair.split("=", 1) for pair in options.key)
    rows = store.lookup(options.table, values) if values else store.read(options.table)
    if options.where:
        rows = rows.where(options.where)
    rows.printSchema()
    rows.show(20, truncate=True)
    print(f"rows: {rows.count()}")


if __name__ == "__main__":
    run(main, "show-table")
