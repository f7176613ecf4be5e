"""Which raw batches count, and which of them a conformed table holds.

Beside a raw table lies a table of records: one row when a batch begins and one when it is committed, the latter with
row count, watermark and log range. Each is a single row in a single file, so it is there or it is not. A batch that
has begun and is not committed (its load runs or has crashed) counts as absent, whatever rows of it are in the table
already. A batch without any record, as another writer may append it, counts as committed.

Beside a conformed table lies a ledger: one row per applied raw batch with the number of the load that applied it. The
rows are written before the table is published, and the publishing statement names the load number, so a row counts
from that statement on and not before. Nothing is forgotten: a batch is found however late it is committed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import column
from ..operators.ingest import BATCH_DATE, BATCH_ID, INGESTED_AT
from ..sources.tables import TableStore

RECORDS_MARK = "__batches"
LEDGER_MARK = "__applied"
RECORD_SCHEMA = (
    "batch_id STRING, committed BOOLEAN, batch_at TIMESTAMP, row_count BIGINT, watermark STRING, "
    "from_position STRING, to_position STRING"
)
# Number of the last load that was published, and of the last one before the snapshot the table starts from.
SEQUENCE = "tidemark.sequence"
EPOCH = "tidemark.epoch"


@dataclass(frozen=True)
class RawBatches:
    """The batches of one raw table."""

    store: TableStore
    raw_table: str

    @property
    def table(self) -> str:
        return self.raw_table + RECORDS_MARK

    def begin(self, batch_id: str) -> None:
        self._add(batch_id, committed=False)

    def commit(self, batch_id: str, rows: int, watermark: str | None = None,
               from_position: str | None = None, to_position: str | None = None) -> None:
        self._add(batch_id, True, rows, watermark, from_position, to_position)

    def _add(self, batch_id: str, committed: bool, *facts: object) -> None:
        values = (batch_id, committed, *facts, *[None] * (4 - len(facts)))
        kinds = [part.rsplit(" ", 1) for part in RECORD_SCHEMA.split(", ")]
        filled = [values[0], values[1], F.current_timestamp(), *values[2:]]
        row = self.store.spark.range(1).select(*[
            (value if name == "batch_at" else F.lit(value)).cast(kind).alias(name)
            for (name, kind), value in zip(kinds, filled, strict=True)
        ])
        self.store.append(row.coalesce(1), self.table)

    def records(self) -> DataFrame | None:
        """The committed batches' records, None where no load has written any."""
        found = self.store.read_if_exists(self.table)
        return None if found is None else found.filter("committed")

    def mark(self, name: str) -> str | None:
        """Highest ``watermark`` or ``to_position`` of the committed batches."""
        records = self.records()
        return None if records is None else records.agg(F.max(column(name)).alias("mark")).first()["mark"]

    def newest(self, rows: DataFrame) -> DataFrame | None:
        """``rows`` of the batch that was committed last and has some, read from its days alone; None without a record.

        Its id and days come from the records, so the raw table is not scanned to find them.
        """
        records = self.store.read_if_exists(self.table)
        if records is None or BATCH_ID not in rows.columns:
            return None
        batch = records.groupBy("batch_id").agg(
            F.max("committed").alias("done"), F.max("row_count").alias("row_count"),
            F.min("batch_at").alias("begun"), F.max("batch_at").alias("ended"))
        found = batch.filter("done AND row_count > 0").agg(
            F.max_by(F.struct("batch_id", F.date_sub(F.to_date("begun"), 1), F.date_add(F.to_date("ended"), 1)),
                     F.struct("ended", "batch_id")).alias("b")).first()["b"]
        if found is None:
            return None
        batch_id, first, last = found
        own = rows.filter(column(BATCH_ID) == batch_id)
        # A day of slack on both sides covers a change of the session's time zone.
        return own.filter(column(BATCH_DATE).between(first, last)) if BATCH_DATE in rows.columns else own

    def committed(self, rows: DataFrame) -> DataFrame:
        """``rows`` of the raw table without those of batches that have begun only."""
        records = self.store.read_if_exists(self.table)
        if records is None or BATCH_ID not in rows.columns:
            return rows
        # One row per crashed or running load.
        opened = records.groupBy("batch_id").agg(F.max("committed").alias("done")).filter(~F.col("done"))
        return rows.alias("r").join(
            opened.select("batch_id").alias("o"), column(BATCH_ID, "r") == F.col("o.batch_id"), "left_anti")


@dataclass(frozen=True)
class Ledger:
    """The raw batches that one conformed table holds."""

    store: TableStore
    conformed_table: str

    @property
    def table(self) -> str:
        return self.conformed_table + LEDGER_MARK

    def applied(self, properties: dict[str, str]) -> DataFrame | None:
        """Ids of the batches in the published table; none from before the snapshot it starts from."""
        rows = self.store.read_if_exists(self.table)
        if rows is None:
            return None
        low, high = int(properties.get(EPOCH, 0)), int(properties.get(SEQUENCE, 0))
        return rows.filter((F.col("sequence") > low) & (F.col("sequence") <= high)).select("batch_id")

    def pending(self, rows: DataFrame, properties: dict[str, str]) -> DataFrame:
        """One row per batch in ``rows`` that the table does not hold: ``batch_id``, ``batch_at``, ``batch_day``.

        Reads the id, time and day of the rows only. Both are constant within a batch, so next to nothing leaves a
        task. Rows without an id are told by their time.
        """
        found = rows.select(
            _identity(rows).alias("batch_id"), column(INGESTED_AT).alias("batch_at"), _day(rows).alias("batch_day"))
        found = found.groupBy("batch_id").agg(
            F.max("batch_at").alias("batch_at"), F.min("batch_day").alias("first_day"), F.max("batch_day").alias("last_day"))
        applied = self.applied(properties)
        return found if applied is None else found.join(applied, "batch_id", "left_anti")

    def enter(self, pending: DataFrame, sequence: int) -> None:
        """Note the batches under a load number; they count once the table is published with it."""
        self.store.append(pending.withColumn("sequence", F.lit(sequence).cast("bigint")), self.table)

    def entered(self, sequence: int) -> DataFrame:
        return self.store.read(self.table).filter(F.col("sequence") == sequence)

    def rows_of(self, rows: DataFrame, sequence: int) -> DataFrame:
        """``rows`` of the batches noted under a load number.

        A load that crashed between its note and its publication left its batches under the same number. They are
        pending still, so they are among those noted now.
        """
        batches = self.entered(sequence).select("batch_id").distinct()
        if BATCH_DATE in rows.columns:
            # Prunes partitions; batches in between are told apart by the join.
            days = self.entered(sequence).agg(F.min("first_day").alias("first"), F.max("last_day").alias("last")).first()
            rows = rows.filter(column(BATCH_DATE).between(F.lit(days["first"]), F.lit(days["last"])))
        return rows.alias("r").join(batches.alias("b"), _identity(rows, "r") == F.col("b.batch_id"), "left_semi")


def _identity(rows: DataFrame, alias: str | None = None):
    time = F.unix_micros(column(INGESTED_AT, alias)).cast("string")
    return F.coalesce(column(BATCH_ID, alias), time) if BATCH_ID in rows.columns else time


def _day(rows: DataFrame):
    return column(BATCH_DATE) if BATCH_DATE in rows.columns else F.to_date(column(INGESTED_AT))
