"""Parquet files as a source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .base import FrameSource


def read_parquet(spark: SparkSession, directory: str, name: str, schema: str | None = None) -> DataFrame:
    """One table of a directory; a known schema saves the job that reads it from a file footer."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{directory.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class ParquetSource(FrameSource):
    """Tables and change feeds, each one Parquet path of its name below ``directory``."""

    spark: SparkSession | None = None
    directory: str = "."

    def table(self, name: str) -> DataFrame:
        return read_parquet(self.spark, self.directory, name)

    def feed(self, capture_instance: str) -> DataFrame:
        return read_parquet(self.spark, self.directory, capture_instance)
