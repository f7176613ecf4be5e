"""A relational source over JDBC. Connection options come from the caller; nothing is read from the environment."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, Row, SparkSession

from ..functions import column
from ..operators.ingest import CHANGE_COLUMNS
from ..spec import ChangeFeed, SpecError, TableSpec
from .base import feed_columns

_LSN = re.compile(r"0x[0-9A-Fa-f]{20}")
_NAME = re.compile(r"\w+")


def jdbc_url(host: str, database: str, port: int = 1433, encrypt: bool = False, trust_certificate: bool = True) -> str:
    settings = {
        "databaseName": database,
        "encrypt": str(encrypt).lower(),
        "trustServerCertificate": str(trust_certificate).lower(),
    }
    return f"jdbc:sqlserver://{host}:{port};" + "".join(f"{k}={v};" for k, v in settings.items())


@dataclass(frozen=True)
class JdbcSource:
    spark: SparkSession
    # url, user, password, driver and whatever else the connector takes.
    options: Mapping[str, str]
    # Connections per table read, split on the spec's numeric partition_column.
    num_partitions: int = 1
    fetch_size: int = 10_000
    # Type that watermark literals are cast to in the source's dialect.
    timestamp_type: str = "DATETIME2"
    # Split at quantiles of the key, counted by the source, instead of at equal strides between its ends. Costs the
    # source one more pass over the key; the remedy for keys that crowd in a part of their range.
    by_quantiles: bool = False
    system: str = "sqlserver"

    def query(self, sql: str, split: Mapping[str, object] | None = None) -> DataFrame:
        """Any SELECT of the source's dialect as a frame; ``split`` makes it a parallel read."""
        reader = (
            self.spark.read.format("jdbc")
            .options(**self.options)
            .option("dbtable", f"({sql}) AS src")
            .option("fetchsize", str(self.fetch_size))
            .option("preferTimestampNTZ", "true")
        )
        for name, value in (split or {}).items():
            reader = reader.option(name, str(value))
        return reader.load()

    def query_ranges(self, sql: str, predicates: Sequence[str]) -> DataFrame:
        """A SELECT read over one connection per predicate, which together must take every row once."""
        if not predicates:
            return self.query(sql)
        settings = {k: str(v) for k, v in self.options.items() if k != "url"}
        settings |= {"fetchsize": str(self.fetch_size), "preferTimestampNTZ": "true"}
        return self.spark.read.jdbc(
            self.options["url"], f"({sql}) AS src", predicates=list(predicates), properties=settings)

    def quantiles_text(self, sql: str, key: str) -> str:
        """First key and number of rows of each of ``num_partitions`` runs of equally many rows of ``sql``, by key."""
        return (
            f"SELECT tile, MIN({key}) AS lo, COUNT(*) AS n FROM "
            f"(SELECT {key}, NTILE({self.num_partitions}) OVER (ORDER BY {key}) AS tile FROM ({sql}) AS wanted "
            f"WHERE {key} IS NOT NULL) AS tiled GROUP BY tile"
        )

    def _quantile_predicates(self, sql: str, key: str) -> list[str]:
        """Ranges of about equally many rows. A key that fills several runs is one range, for it cannot be split."""
        starts = sorted({row["lo"] for row in self.query(self.quantiles_text(sql, key)).collect()})  # one row per run
        if len(starts) < 2:
            return []
        cuts = [_literal(start) for start in starts[1:]]
        inner = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(cuts, cuts[1:])]
        return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]

    def scalar(self, sql: str, column_name: str) -> object | None:
        """One column of the first row, or None when there is no row."""
        row = self.query(sql).first()
        return None if row is None else row[column_name]

    def probe(self) -> bool:
        return self.scalar("SELECT 1 AS reachable", "reachable") == 1

    def sample(self, schema: str, table: str, columns: Sequence[str], key: str, n: int = 5) -> DataFrame:
        """The first ``n`` rows by key; the source itself sorts and cuts."""
        return self.query(
            f"SELECT {', '.join(columns)} FROM {schema}.{table} ORDER BY {key} OFFSET 0 ROWS FETCH NEXT {n} ROWS ONLY"
        )

    def rows(self, spec: TableSpec, last_watermark: str | None = None) -> DataFrame:
        """The rows to load, over several connections where the spec names a column to split on.

        Connections read at different moments, so they share an upper watermark taken beforehand: a row that changes
        in between lies above it and is left to the next load, instead of falling below a mark seen elsewhere.
        """
        key, upper, split = spec.partition_column, None, None
        if self.num_partitions > 1 and key is not None:
            wanted = f"MIN({key}) AS lo, MAX({key}) AS hi"
            if spec.strategy.uses_watermark:
                wanted += f", MAX({spec.watermark_column}) AS newest"
            bounds = self.query(self.select_text(spec, last_watermark, wanted)).first()
            split = self._split(key, bounds)
            upper = _just_after(bounds["newest"]) if split and spec.strategy.uses_watermark else None
        text = self.select_text(spec, last_watermark, upper=upper)
        if split and self.by_quantiles:
            wanted = self.select_text(spec, last_watermark, key, upper)
            return self.query_ranges(text, self._quantile_predicates(wanted, key)).drop(*spec.exclude_columns)
        return self.query(text, split).drop(*spec.exclude_columns)

    def select_text(
        self, spec: TableSpec, last_watermark: str | None, columns: str | None = None, upper: str | None = None
    ) -> str:
        chosen = columns or ", ".join(c for c in spec.columns if c not in spec.exclude_columns)
        text = f"SELECT {chosen} FROM {spec.source_schema}.{spec.source_table}"
        if not spec.strategy.uses_watermark:
            return text
        if not last_watermark:
            raise SpecError(f"{spec.table_id}: the last watermark is required for {spec.strategy.value}")
        lower = self._timestamp(last_watermark)
        if spec.lookback_seconds:
            lower = f"DATEADD(second, -{spec.lookback_seconds}, {lower})"
        text += f" WHERE {spec.watermark_column} > {lower}"
        return text if upper is None else f"{text} AND {spec.watermark_column} <= {self._timestamp(upper)}"

    def _timestamp(self, text: str) -> str:
        literal = text.replace("'", "''")
        return f"CAST('{literal}' AS {self.timestamp_type})"

    def _split(self, key: str, bounds: Row | None) -> dict[str, object] | None:
        """Ranges over the rows this load will read, so that an increment at the top of the keys spreads too."""
        if bounds is None or bounds["lo"] is None or bounds["lo"] == bounds["hi"]:
            return None
        return {
            "partitionColumn": key,
            "lowerBound": bounds["lo"],
            "upperBound": bounds["hi"],
            "numPartitions": self.num_partitions,
        }

    def changes(self, spec: TableSpec, lower: str | None, upper: str) -> DataFrame:
        feed = spec.change_feed
        key = feed.partition_column
        if self.num_partitions == 1 or key is None:
            read = self.query
        elif self.by_quantiles:
            ranges = self._quantile_predicates(self.changes_text(feed, lower, upper, key), key)

            def read(text: str) -> DataFrame:
                return self.query_ranges(text, ranges)
        else:
            wanted = f"MIN({key}) AS lo, MAX({key}) AS hi"
            split = self._split(key, self.query(self.changes_text(feed, lower, upper, wanted)).first())

            def read(text: str) -> DataFrame:
                return self.query(text, split)
        if tuple(spec.columns) == ("*",):
            # The columns are the feed's own; excluded ones are left out of the statement Spark sends.
            found = read(self.changes_text(feed, lower, upper))
            return found.select(*[column(c) for c in feed_columns(spec, found.columns)])
        listed = [*CHANGE_COLUMNS, *(c for c in spec.columns if c not in spec.exclude_columns)]
        return read(self.changes_text(feed, lower, upper, ", ".join(listed)))

    def changes_text(self, feed: ChangeFeed, lower: str | None, upper: str, columns: str = "*") -> str:
        """The captured rows of the feed's change table with a position in ``(lower, upper]``."""
        for position in filter(None, (lower, upper)):
            if not _LSN.fullmatch(position):
                raise SpecError(f"not a log position: {position!r}")
        terms = [f"__$start_lsn <= {upper}"]
        if lower is not None:
            terms.append(f"__$start_lsn > {lower}")
        if feed.row_filter_option == "all":
            terms.append("__$operation <> 3")
        return f"SELECT {columns} FROM cdc.{_identifier(feed.capture_instance)}_CT WHERE {' AND '.join(terms)}"

    def max_position(self, capture_instance: str) -> str | None:
        return self._position("sys.fn_cdc_get_max_lsn()")

    def min_position(self, capture_instance: str) -> str | None:
        return self._position(f"sys.fn_cdc_get_min_lsn('{_identifier(capture_instance)}')")

    def _position(self, call: str) -> str | None:
        return self.scalar(f"SELECT CONVERT(varchar(42), {call}, 1) AS lsn", "lsn")


def _identifier(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise SpecError(f"not a capture instance name: {name!r}")
    return name


def _literal(key: object) -> str:
    """A key the source has given, as a literal of its dialect."""
    if isinstance(key, (int, Decimal)) and not isinstance(key, bool):
        return str(key)
    return "'" + str(key).replace("'", "''") + "'"


def _just_after(watermark: date) -> str:
    """The watermark as text, rounded up: sources may keep more digits than the microseconds Spark reads."""
    return str(watermark + timedelta(microseconds=1))
