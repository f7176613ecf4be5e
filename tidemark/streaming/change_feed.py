"""The change feed as a stream: the query's checkpoint remembers which change rows were applied."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.loads import LoadError, merge_rows
from ..sources.tables import TableStore
from ..spec import LoadStrategy, SpecError, TableSpec

# Query and number of the last micro-batch in the published table.
STREAM_BATCH = "tidemark.stream_batch"
# Local property in which a stream names its query; the id lasts as long as its checkpoint.
QUERY_ID = "sql.streaming.queryId"


def stream_raw_changes(store: TableStore, spec: TableSpec, files_per_batch: int | None = None) -> DataFrame:
    """The raw change table as a stream: every batch appended to it, once.

    ``files_per_batch`` bounds what one micro-batch takes in, for a backlog that is too large for one merge.
    """
    reader = store.spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.table(spec.raw_table)


def apply_change_feed(
    store: TableStore, spec: TableSpec, changes: DataFrame, checkpoint: str | None = None
) -> StreamingQuery:
    """Merge all change rows that have arrived into the conformed table, then stop.

    The statement that publishes a micro-batch names it, so one that is repeated after a failure is passed over without a
    second rewrite. Micro-batches may come in any order: the table keeps each key's last log position, and a change
    before it changes nothing.
    """
    if spec.strategy is not LoadStrategy.INCREMENTAL_CDC:
        raise SpecError(f"{spec.table_id} loads no change feed, its strategy is {spec.strategy.value}")
    if not store.exists(spec.conformed_table):
        raise LoadError(f"{spec.table_id}: changes need a table to go into, {spec.conformed_table} is not there yet")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        merge_once(store, spec, batch, batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID), batch_id)

    return (
        changes.writeStream.queryName(f"change feed {spec.table_id}")
        .option("checkpointLocation", checkpoint or _default_checkpoint(store, spec))
        .trigger(availableNow=True)
        .foreachBatch(merge_batch)
        .start()
    )


def merge_once(store: TableStore, spec: TableSpec, batch: DataFrame, query_id: str | None, batch_id: int) -> bool:
    """Merge a micro-batch unless the table holds it already; numbers grow within a query.

    A new checkpoint is a new query, whose numbers start again. A batch whose query is unknown is merged.
    """
    query, _, last = store.properties(spec.conformed_table).get(STREAM_BATCH, "").partition("@")
    if query_id and query == query_id and batch_id <= int(last):
        return False
    columns = store.read(spec.conformed_table).columns
    mark = {STREAM_BATCH: f"{query_id}@{batch_id}"} if query_id else {}
    rows = merge_rows(spec, batch, columns)
    store.merge(rows, spec.conformed_table, spec.primary_key, changes=True, properties=mark)
    return True


def _default_checkpoint(store: TableStore, spec: TableSpec) -> str:
    shared = store.spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        raise ValueError("name a checkpoint folder or set spark.checkpoint.dir")
    return f"{shared.rstrip('/')}/change_feed/{spec.table_id}"
