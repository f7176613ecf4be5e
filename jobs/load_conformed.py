"""spark-submit jobs/load_conformed.py <table_id>: apply pending raw batches to the conformed layer."""

from __future__ import annotations

from jobs.common import parser, retail_specs, run
from tidemark.plans import load_conformed
from tidemark.sources import TableStore


def main(argv, spark) -> None:
    args = parser(__doc__, "table_id")
    args.add_argument("--buckets", type=int, default=0, help="buckets of a conformed table that is created")
    args.add_argument("--parts", type=int, default=0, help="parts of a conformed table that is created")
    options = args.parse_args(argv)
    spec = retail_specs(options.catalog, options.buckets, options.parts)[options.table_id]
    result = load_conformed(TableStore(spark), spec)
    print(f"{spec.conformed_table}: {'updated' if result.changed else 'nothing to apply'}")


if __name__ == "__main__":
    run(main, "load-conformed")
