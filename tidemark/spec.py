"""Table specifications: what to load, from where, by which strategy."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from enum import Enum
from typing import Any


class SpecError(ValueError):
    """A table specification that cannot be loaded as written."""


class LoadStrategy(str, Enum):
    FULL_SNAPSHOT = "full_snapshot"
    INCREMENTAL_UPSERT = "incremental_upsert"
    INCREMENTAL_SOFT_DELETE = "incremental_with_soft_delete"
    INCREMENTAL_CDC = "incremental_cdc"

    @property
    def uses_watermark(self) -> bool:
        return self in (LoadStrategy.INCREMENTAL_UPSERT, LoadStrategy.INCREMENTAL_SOFT_DELETE)


@dataclass(frozen=True)
class ChangeFeed:
    """Where the change rows of a table come from."""

    capture_instance: str
    # "all" leaves out update-before rows, "all update old" delivers them too.
    row_filter_option: str = "all"
    # Raw snapshot table whose audit columns hold the position to start from.
    baseline_table: str | None = None
    # Numeric captured column to split a JDBC read on.
    partition_column: str | None = None

    def __post_init__(self) -> None:
        if not self.capture_instance:
            raise SpecError("a change feed needs a capture_instance")
        if self.row_filter_option not in ("all", "all update old"):
            raise SpecError(f"unknown row_filter_option {self.row_filter_option!r}")


@dataclass(frozen=True)
class TableSpec:
    table_id: str
    source_schema: str
    source_table: str
    raw_table: str
    conformed_table: str
    primary_key: tuple[str, ...]
    strategy: LoadStrategy
    columns: tuple[str, ...] = ("*",)
    # Columns that must not leave the source (credentials and the like).
    exclude_columns: tuple[str, ...] = ()
    watermark_column: str | None = None
    # Further columns that make the watermark a total order within one key.
    tie_breakers: tuple[str, ...] = ()
    initial_watermark: str | None = None
    # Seconds to reach back behind the watermark for late commits.
    lookback_seconds: int = 0
    soft_delete_column: str | None = None
    change_feed: ChangeFeed | None = None
    # Capture instance whose position a snapshot records before it reads.
    baseline_capture_instance: str | None = None
    # Numeric source column to split a JDBC read on.
    partition_column: str | None = None
    # Buckets by key of a new conformed table; merges then shuffle the batch only. 0 stores it unbucketed. Only for
    # tables with one row per key: all versions of a key would share one bucket, however many they are.
    buckets: int = 0
    # Parts by key of a new conformed table in the session catalog; a load then rewrites the parts its keys lie in. 0
    # stores it as a whole. A part should hold some hundred megabytes, or small batches touch them all.
    parts: int = 0

    def __post_init__(self) -> None:
        object.__setattr__(self, "strategy", _strategy(self.strategy))
        for name in ("primary_key", "columns", "exclude_columns", "tie_breakers"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        if not self.primary_key:
            raise SpecError(f"{self.table_id}: primary_key must not be empty")
        if not self.columns:
            raise SpecError(f"{self.table_id}: columns must not be empty")
        if self.strategy.uses_watermark and not self.watermark_column:
            raise SpecError(f"{self.table_id}: strategy {self.strategy.value} requires a watermark_column")
        if self.strategy is LoadStrategy.INCREMENTAL_CDC and self.change_feed is None:
            raise SpecError(f"{self.table_id}: strategy incremental_cdc requires a capture_instance")
        if min(self.lookback_seconds, self.buckets, self.parts) < 0:
            raise SpecError(f"{self.table_id}: lookback_seconds, buckets and parts must not be negative")
        if self.buckets and self.parts:
            raise SpecError(f"{self.table_id}: a table has buckets or parts, not both")
        if self.buckets and self.strategy is LoadStrategy.INCREMENTAL_UPSERT:
            raise SpecError(f"{self.table_id}: a table of versions is not bucketed by key")

    @property
    def version_order(self) -> tuple[str, ...]:
        """Columns that order the versions of one key, most significant first."""
        return (self.watermark_column, *self.tie_breakers) if self.watermark_column else self.tie_breakers

    @classmethod
    def from_mapping(cls, table_id: str, config: Mapping[str, Any], **overrides: Any) -> TableSpec:
        """Build a spec from a nested ``source``/``target``/``cdc`` mapping."""
        source, target, cdc = config["source"], config["target"], config.get("cdc") or {}
        feed = None
        if cdc:
            feed = ChangeFeed(
                capture_instance=cdc.get("capture_instance", ""),
                row_filter_option=cdc.get("row_filter_option", "all"),
                baseline_table=cdc.get("baseline_table"),
            )
        values: dict[str, Any] = {
            "table_id": table_id,
            "source_schema": source["schema"],
            "source_table": source["table"],
            "columns": tuple(source.get("query_columns", ("*",))),
            "raw_table": target["bronze_table"],
            "conformed_table": target["silver_table"],
            "primary_key": tuple(config["primary_key"]),
            "strategy": config["load_strategy"],
            "watermark_column": config.get("watermark_column"),
            "soft_delete_column": config.get("soft_delete_column"),
            "initial_watermark": config.get("initial_watermark"),
            "change_feed": feed,
        }
        return cls(**{**values, **overrides})


@dataclass(frozen=True)
class SpecSet:
    """The configured tables of one deployment, looked up by id."""

    specs: Mapping[str, TableSpec] = field(default_factory=dict)

    @classmethod
    def of(cls, *specs: TableSpec) -> SpecSet:
        return cls({spec.table_id: spec for spec in specs})

    def __getitem__(self, table_id: str) -> TableSpec:
        if table_id not in self.specs:
            raise SpecError(f"table {table_id!r} is not configured; available: {', '.join(self.specs)}")
        return self.specs[table_id]

    def __iter__(self):
        return iter(self.specs.values())

    def __len__(self) -> int:
        return len(self.specs)


def _strategy(value: LoadStrategy | str) -> LoadStrategy:
    try:
        return LoadStrategy(value)
    except ValueError:
        known = ", ".join(s.value for s in LoadStrategy)
        raise SpecError(f"unsupported load strategy {value!r}; known: {known}") from None
