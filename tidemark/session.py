"""Session defaults for the jobs. Master, memory and catalogs are left to spark-submit."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings a job sets unless spark-submit already did.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffles start with many partitions, which adaptive execution joins where they are small; it cannot split those of
    # windows and aggregations. Raise it with the input: 100 TB at 4,000 are 25 GB a partition before pruning.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    # A sort-merge join becomes a hash join when every partition of one side is seen to be this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # A task that writes few partitions or buckets, as after a bucketed merge, does not sort its rows for it.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Parquet grows about this much in memory; without it the broadcast limit is checked against file sizes.
    "spark.sql.sources.fileCompressionFactor": "3.0",
}
# Settings that are fixed when the session starts.
STATIC_DEFAULTS = {
    # No stack trace per column expression, which halves the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Checkpoints go when the frames that use them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def job_session(app_name: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in STATIC_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    launched = dict(spark.sparkContext.getConf().getAll())
    if not spark.sparkContext.master.startswith("local") and not spark.conf.get("spark.checkpoint.dir", None):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    for key, value in DEFAULTS.items():
        if key not in launched:
            spark.conf.set(key, value)
    return spark
