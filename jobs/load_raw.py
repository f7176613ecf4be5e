"""spark-submit jobs/load_raw.py <table_id>: read what is new in the source into the raw layer."""

from __future__ import annotations

from jobs.common import open_source, parser, retail_specs, run, source_arguments
from tidemark.plans import load_raw, preview
from tidemark.sources import TableStore


def main(argv, spark) -> None:
    args = source_arguments(parser(__doc__, "table_id"))
    args.add_argument("--preview", action="store_true", help="show five rows of the batch")
    options = args.parse_args(argv)
    spec, store = retail_specs(options.catalog)[options.table_id], TableStore(spark)
    result = load_raw(store, spec, open_source(spark, options))
    print(f"{spec.table_id}: {result.rows} rows into {spec.raw_table}, now at {result.mark}")
    if options.preview and result.changed and result.batch_id:
        preview(store, spec, result.batch_id).show(truncate=False)


if __name__ == "__main__":
    run(main, "load-raw")
