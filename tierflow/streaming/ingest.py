"""Micro-batch ingest of raw event files into silver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tierflow import errors
from tierflow.sinks.tables import Rows, check_stored, insert_if_absent
from tierflow.sources.files import ARRIVED


def ingest_events(
    events: DataFrame,
    path: str,
    checkpoint: str,
    scope: str = "table",
    dedupe_batch: bool = True,
    fmt: str = "parquet",
    merge_schema: bool = False,
    index: str | None = None,
    on_batch: Callable[[int, Rows], None] | None = None,
) -> StreamingQuery:
    """Drain what is new in `events` into the silver table, then stop.

    The table itself is the state of the deduplication, so rows may arrive any
    time late and the stream keeps no state of its own. The caller awaits the
    returned query.

    The first copy of a key to arrive wins, inside a batch as across batches: by
    the time of its file, then the file's name, then the event's time. So the
    size of the batches does not matter, but for files of one and the same time: which of
    those a batch takes first is up to the store, so where a key has copies in several of
    them, and a batch ends between these, another copy may win than if it did not. Still
    exactly one does.

    `on_batch` is called with the number of a batch and the rows stored of it, with the
    partitions the batch has rows for, after they are stored and before the batch counts
    as done: a batch that failed in between is delivered again, and its rows that are
    stored already are not counted again.
    """
    stored = events.drop(ARRIVED)

    def insert(batch: DataFrame, batch_id: int) -> None:
        rows = insert_if_absent(
            batch,
            path,
            scope=scope,
            dedupe_batch=dedupe_batch,
            lineage="_filename",
            order_by=(ARRIVED, "_filename", "time"),
            transient=(ARRIVED,),
            fmt=fmt,
            schema_checked=True,
            index=index,
        )
        if on_batch:
            on_batch(batch_id, rows)

    try:
        check_stored(events.sparkSession, path, stored.schema, fmt=fmt, merge_schema=merge_schema)
        return (
            events.writeStream.foreachBatch(insert)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    except Exception as e:
        raise RuntimeError(errors.WRITE_EVENTS.format(cause=e)) from e


def drain(query: StreamingQuery) -> None:
    """Wait for a query to stop; its failure becomes the caller's."""
    try:
        query.awaitTermination()
    except Exception as e:
        raise RuntimeError(errors.WRITE_EVENTS.format(cause=e)) from e
