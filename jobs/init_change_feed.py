"""spark-submit jobs/init_change_feed.py <table_id>: snapshot a table so that its change feed can start.

The log position is taken before the snapshot is read and kept with the snapshot's raw rows.
"""

from __future__ import annotations

from jobs.common import open_source, parser, retail_specs, run, source_arguments
from tidemark.plans import load_conformed, load_raw
from tidemark.sources import TableStore
from tidemark.spec import LoadStrategy, SpecError


def main(argv, spark) -> None:
    args = source_arguments(parser(__doc__, "table_id"))
    args.add_argument("--buckets", type=int, default=0, help="buckets of the conformed table")
    options = args.parse_args(argv)
    specs = retail_specs(options.catalog, options.buckets)
    spec = specs[options.table_id]
    if spec.strategy is not LoadStrategy.INCREMENTAL_CDC:
        raise SpecError(f"{spec.table_id} loads no change feed, its strategy is {spec.strategy.value}")
    snapshot = next((s for s in specs if s.raw_table == spec.change_feed.baseline_table), None)
    if snapshot is None:
        raise SpecError(f"{spec.table_id} names no snapshot table to start from")
    store = TableStore(spark)
    result = load_raw(store, snapshot, open_source(spark, options))
    load_conformed(store, snapshot)
    print(f"{spec.table_id}: change feed starts at {result.mark}")


if __name__ == "__main__":
    run(main, "init-change-feed")
