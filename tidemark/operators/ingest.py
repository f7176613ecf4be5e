"""Selecting what to load from a source, and stamping it for the raw layer."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import column
from ..spec import SpecError, TableSpec

# Column names of the change feed and of the raw layer.
START_LSN = "__$start_lsn"
SEQVAL = "__$seqval"
OPERATION = "__$operation"
UPDATE_MASK = "__$update_mask"
CHANGE_COLUMNS = (START_LSN, SEQVAL, OPERATION, UPDATE_MASK)

INGESTED_AT = "bronze_ingestion_timestamp"
BATCH_ID = "bronze_batch_id"
CDC_TO = "bronze_cdc_to_lsn"
AUDIT_COLUMNS = (
    INGESTED_AT,
    BATCH_ID,
    "bronze_table_id",
    "bronze_source_system",
    "bronze_source_schema",
    "bronze_source_table",
    "bronze_load_strategy",
    "bronze_watermark_column",
    "bronze_watermark_used",
    "bronze_soft_delete_column",
    "bronze_cdc_from_lsn",
    CDC_TO,
)
# Physical layout only: day of ingestion, the partition column of raw tables.
BATCH_DATE = "bronze_batch_date"


def select_columns(df: DataFrame, columns: Iterable[str] = ("*",), exclude: Iterable[str] = ()) -> DataFrame:
    """Explicit column list, or everything for ``*``, without the excluded columns."""
    wanted, hidden = list(columns), set(exclude)
    names = df.columns if wanted == ["*"] else wanted
    return df.select(*[column(c) for c in names if c not in hidden])


def select_incremental(
    df: DataFrame,
    watermark_column: str,
    last_watermark: str | None,
    lookback_seconds: int = 0,
) -> DataFrame:
    """Rows strictly after the watermark. The predicate is a plain comparison, so the scan takes it."""
    if not watermark_column:
        raise SpecError("an incremental select requires a watermark_column")
    if not last_watermark:
        raise SpecError("an incremental select requires the last watermark")
    bound = F.lit(last_watermark).cast(df.schema[watermark_column].dataType)
    if lookback_seconds:
        bound = bound - F.make_dt_interval(secs=F.lit(lookback_seconds))
    return df.filter(column(watermark_column) > bound)


def select_changes(df: DataFrame, lower: Column, upper: Column, position: str = START_LSN) -> DataFrame:
    """Changes in the half-open range ``(lower, upper]``."""
    return df.filter((column(position) > lower) & (column(position) <= upper))


def with_audit_columns(
    df: DataFrame,
    spec: TableSpec,
    source_system: str = "sqlserver",
    last_watermark: str | None = None,
    cdc_from: str | None = None,
    cdc_to: str | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Add the twelve audit columns; values that do not apply are empty strings."""
    texts = (
        batch_id or str(uuid.uuid4()),
        spec.table_id,
        source_system,
        spec.source_schema,
        spec.source_table,
        spec.strategy.value,
        spec.watermark_column,
        last_watermark,
        spec.soft_delete_column,
        cdc_from,
        cdc_to,
    )
    stamps = {name: F.lit(text or "") for name, text in zip(AUDIT_COLUMNS[1:], texts, strict=True)}
    return df.withColumns({INGESTED_AT: F.current_timestamp(), **stamps})
