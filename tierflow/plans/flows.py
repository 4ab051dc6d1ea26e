"""The jobs of the pipeline: each moves one table one tier up."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import SparkSession

from tierflow.operators.bounds import Moment, Window, ingest_window, month_window
from tierflow.operators.events import stringify_timestamps
from tierflow.plans.gold import SilverTables, gold_wide
from tierflow.session import configure
from tierflow.sinks.marks import current_mark, planned_window, record_mark
from tierflow.sinks.tables import (
    Rows,
    add_partitions,
    append,
    load_name,
    overwrite_partitions,
    put_load,
    register,
    replace_distinct,
    replace_version,
)
from tierflow.sources.control import Spec
from tierflow.sources.files import event_stream, read_dimension, remembered_schema
from tierflow.sources.relational import read_table
from tierflow.streaming.ingest import ARRIVED, drain, ingest_events

log = logging.getLogger("tierflow")


@dataclass(frozen=True)
class Load:
    """What a source load did."""

    rows: Rows
    window: Window | None


def source_to_bronze(
    spark: SparkSession,
    spec: Spec,
    backfill: tuple[Moment, Moment] | None = None,
    now: Moment | None = None,
) -> Load:
    """Store the source rows of the next window in the raw tier.

    The rows of a window are one load, which a repetition replaces. A scheduled window is planned
    before it is read and its mark moves after it is stored: a load lost in between is repeated
    with the same window, and leaves one copy. Of loads that ran at the same time one moves the
    mark, the others raise. Back-fills leave the mark alone; tables without a delta column are
    appended as a whole.
    """
    configure(spark)
    window = mark = None
    if spec.delta:
        mark = None if backfill else current_mark(spark, spec.marks_path, spec.ingest)
        window = ingest_window(backfill, mark and (mark.hi or spec.start_date), spec.end_date, now)
        if mark:
            window = planned_window(spark, spec.marks_path, spec.ingest, mark, window)
    df = read_table(
        spark,
        spec.source_format,
        spec.source_options,
        spec.table,
        list(spec.columns),
        spec.delta,
        window,
        split=spec.delta_is_time,
    )
    df = stringify_timestamps(df, spec.columns)
    rows = put_load(df, spec.bronze_path, load_name(window)) if window else append(df, spec.bronze_path)
    log.info("%s: %d rows stored in %s", spec.ingest, rows, spec.bronze_path)
    if mark:
        record_mark(spark, spec.marks_path, spec.ingest, window, mark)
    return Load(rows, window)


def events_to_silver(
    spark: SparkSession,
    spec: Spec,
    scope: str = "table",
    dedupe_batch: bool = True,
    evolve: bool = False,
    index: bool = False,
) -> Rows:
    """Drain new raw files into the silver event table and register it.

    Returned are the rows that this drain stored. `index` looks keys up in the key index, which
    it keeps. A batch's partitions are registered with the batch; a table that is new is
    registered at the end.
    """
    configure(spark)
    schema = remembered_schema(spark, spec.bronze_path, spec.schema_path, spec.bronze_format, evolve)
    events = event_stream(spark, spec.bronze_path, schema, spec.bronze_format, spec.bronze_options)
    # By number, so that a batch which is delivered again counts once.
    batches: dict[int, Rows] = {}

    def stored(batch_id: int, rows: Rows) -> None:
        batches[batch_id] = rows
        if spec.silver_format != "delta":
            add_partitions(spark, spec.db, spec.table, "date", rows.partitions)

    drain(
        ingest_events(
            events,
            spec.silver_path,
            spec.checkpoint_path,
            scope,
            dedupe_batch,
            spec.silver_format,
            evolve,
            spec.index_path if index else None,
            stored,
        )
    )
    rows = reduce(Rows.plus, batches.values(), Rows(0))
    schema = events.drop(ARRIVED).schema
    register(spark, spec.db, spec.table, spec.silver_path, schema, "date", spec.silver_format, partitions=rows.partitions)
    log.info("%s: %d rows of %d batches stored in %s.%s", spec.ingest, rows, len(batches), spec.db, spec.table)
    return rows


def dimension_to_silver(
    spark: SparkSession, spec: Spec, key: str | None = None, latest_by: str | None = None
) -> Rows:
    """Replace a silver dimension by the distinct raw rows, or by the latest one of
    each key, and register it (E3).

    The new rows are a version of their own, to which the registered table is pointed once it is
    complete: readers never miss the table, and a run that fails leaves the one before. Formats
    with a transaction log replace in place.
    """
    configure(spark)
    df = read_dimension(spark, spec.bronze_path)

    def switch(path: str) -> None:
        register(spark, spec.db, spec.table, path, df.schema, fmt=spec.silver_format)

    if spec.silver_format == "delta":
        rows = replace_distinct(df, spec.silver_path, spec.silver_format, key, latest_by)
        switch(spec.silver_path)
    else:
        rows = replace_version(df, spec.silver_path, switch, spec.silver_format, key, latest_by)
    log.info("%s: %d rows in %s.%s", spec.ingest, rows, spec.db, spec.table)
    return rows


def bronze_to_silver(spark: SparkSession, spec: Spec, table_type: str = "event", **options: Any) -> Rows:
    """Move one table from bronze to silver by its kind, with the options of
    :func:`events_to_silver` or :func:`dimension_to_silver` (E2, E3)."""
    if table_type == "event":
        return events_to_silver(spark, spec, **options)
    if table_type == "dimension":
        return dimension_to_silver(spark, spec, **options)
    raise ValueError(f"table_type must be 'event' or 'dimension', not {table_type!r}")


def silver_to_gold(
    spark: SparkSession,
    spec: Spec,
    name: str = "wide_hourly",
    month: Moment | None = None,
    how: Mapping[str, str] | None = None,
) -> Rows:
    """Recompute the wide hourly table for one month and register it (E4). A run that fails has to
    be repeated: partitions are registered by the run that wrote them."""
    configure(spark)
    first, last = month_window(month)
    wide = gold_wide(SilverTables.registered(spark, spec.db), first, last, how)
    path = spec.gold_path(name)
    rows = overwrite_partitions(wide, path, fmt=spec.gold_format)
    register(spark, spec.db, name, path, wide.schema, "date", spec.gold_format, partitions=rows.partitions)
    log.info("%d rows for %s to %s in %s.%s", rows, first, last, spec.db, name)
    return rows
