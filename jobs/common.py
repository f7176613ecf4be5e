"""Arguments and connections the jobs share."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from tidemark.retail import retail_specs
from tidemark.session import job_session
from tidemark.sources import JdbcSource, ParquetSource, Source

# JDBC options come from the Spark configuration, e.g. a --properties-file that holds the password.
JDBC_PREFIX = "spark.tidemark.jdbc."


def parser(description: str, *positional: str) -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description=description)
    for name in positional:
        args.add_argument(name)
    args.add_argument("--catalog", help="catalog of the layer tables; the session catalog when left out")
    return args


def source_arguments(args: argparse.ArgumentParser) -> argparse.ArgumentParser:
    args.add_argument("--parquet", metavar="DIR", help="read <DIR>/<table>.parquet instead of JDBC")
    args.add_argument("--connections", type=int, default=8, help="parallel JDBC connections per table")
    args.add_argument("--quantiles", action="store_true", help="split JDBC reads by row counts, for skewed keys")
    return args


def open_source(spark: SparkSession, options: argparse.Namespace) -> Source:
    if options.parquet:
        return ParquetSource(spark=spark, directory=options.parquet)
    return jdbc_source(spark, options.connections, options.quantiles)


def jdbc_source(spark: SparkSession, connections: int = 1, by_quantiles: bool = False) -> JdbcSource:
    settings = dict(spark.sparkContext.getConf().getAll())
    found = {k.removeprefix(JDBC_PREFIX): v for k, v in settings.items() if k.startswith(JDBC_PREFIX)}
    if "url" not in found:
        raise ValueError(f"set {JDBC_PREFIX}url (and user, password, driver) in the Spark configuration")
    return JdbcSource(spark, found, num_partitions=connections, by_quantiles=by_quantiles)


def run(main: Callable[[Sequence[str] | None, SparkSession], None], name: str) -> None:
    """Run a job's main in a session of its own."""
    spark = job_session(name)
    try:
        main(None, spark)
    finally:
        spark.stop()


__all__ = ["jdbc_source", "open_source", "parser", "retail_specs", "run", "source_arguments"]
