"""spark-submit jobs/probe_source.py: can the source be reached? With --sample, show five of its products."""

from __future__ import annotations

from jobs.common import jdbc_source, parser, run

# The columns of the sample.
SAMPLE_COLUMNS = ("ProductID", "Name", "ProductNumber", "ModifiedDate", "DiscontinuedDate")


def main(argv, spark) -> None:
    args = parser(__doc__)
    args.add_argument("--sample", action="store_true")
    options = args.parse_args(argv)
    source = jdbc_source(spark)
    if not source.probe():
        raise RuntimeError("the source answered, but not with the probe's value")
    print("source reachable")
    if options.sample:
        source.sample("SalesLT", "Product", SAMPLE_COLUMNS, key="ProductID").show(truncate=False)


if __name__ == "__main__":
    run(main, "probe-source")
