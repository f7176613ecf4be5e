"""What a load needs from a source, and a source over frames that are already there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import column, lsn_bytes, lsn_hex
from ..operators.ingest import CHANGE_COLUMNS, OPERATION, START_LSN, select_changes, select_columns, select_incremental
from ..spec import TableSpec


def feed_columns(spec: TableSpec, have: Sequence[str]) -> list[str]:
    """Of a feed's columns its own and the configured ones, in the feed's order; excluded ones never."""
    wanted = None if tuple(spec.columns) == ("*",) else set(spec.columns)
    return [
        c for c in have
        if c in CHANGE_COLUMNS or (c not in spec.exclude_columns and (wanted is None or c in wanted))
    ]


class Source(Protocol):
    system: str

    def rows(self, spec: TableSpec, last_watermark: str | None = None) -> DataFrame:
        """The table's configured columns: all rows, or those after the watermark."""

    def changes(self, spec: TableSpec, lower: str | None, upper: str) -> DataFrame:
        """The feed's own and the table's configured columns of change rows with a position in ``(lower, upper]``; from the start of the log when lower is None."""

    def max_position(self, capture_instance: str) -> str | None:
        """The newest position of the change log as ``0x`` text."""

    def min_position(self, capture_instance: str) -> str | None:
        """The oldest position the change log still holds."""


@dataclass(frozen=True)
class FrameSource:
    """Tables and change feeds given as DataFrames, e.g. Parquet extracts or tables of a catalog."""

    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    feeds: Mapping[str, DataFrame] = field(default_factory=dict)
    system: str = "parquet"

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def feed(self, capture_instance: str) -> DataFrame:
        return self.feeds[capture_instance]

    def rows(self, spec: TableSpec, last_watermark: str | None = None) -> DataFrame:
        df = self.table(spec.source_table)
        if spec.strategy.uses_watermark:
            df = select_incremental(df, spec.watermark_column, last_watermark, spec.lookback_seconds)
        return select_columns(df, spec.columns, spec.exclude_columns)

    def changes(self, spec: TableSpec, lower: str | None, upper: str) -> DataFrame:
        feed = spec.change_feed
        df = self.feed(feed.capture_instance)
        if feed.row_filter_option == "all":
            df = df.filter(column(OPERATION) != 3)
        low = F.lit(b"") if lower is None else lsn_bytes(F.lit(lower))
        found = select_changes(df, low, lsn_bytes(F.lit(upper)))
        return found.select(*[column(c) for c in feed_columns(spec, df.columns)])

    def max_position(self, capture_instance: str) -> str | None:
        return self._bound(capture_instance, F.max)

    def min_position(self, capture_instance: str) -> str | None:
        return self._bound(capture_instance, F.min)

    def _bound(self, capture_instance: str, pick) -> str | None:
        return self.feed(capture_instance).agg(lsn_hex(pick(column(START_LSN))).alias("lsn")).first()["lsn"]
