"""spark-submit jobs/apply_change_feed.py <table_id>: merge new raw change rows as a stream, then stop."""

from __future__ import annotations

from jobs.common import parser, retail_specs, run
from tidemark.sources import TableStore
from tidemark.streaming import apply_change_feed, stream_raw_changes


def main(argv, spark) -> None:
    args = parser(__doc__, "table_id")
    args.add_argument("--checkpoint", help="checkpoint folder; below spark.checkpoint.dir when left out")
    options = args.parse_args(argv)
    spec, store = retail_specs(options.catalog)[options.table_id], TableStore(spark)
    apply_change_feed(store, spec, stream_raw_changes(store, spec), options.checkpoint).awaitTermination()


if __name__ == "__main__":
    run(main, "apply-change-feed")
