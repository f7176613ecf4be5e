"""spark-submit jobs/build_mart.py <dim_customer|dim_product|fact_sales>: rebuild one mart."""

from __future__ import annotations

from jobs.common import parser, run
from tidemark.plans import build_mart
from tidemark.sources import TableStore


def main(argv, spark) -> None:
    options = parser(__doc__, "mart").parse_args(argv)
    print(f"built {build_mart(TableStore(spark), options.mart, options.catalog)}")


if __name__ == "__main__":
    run(main, "build-mart")
