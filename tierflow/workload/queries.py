"""One query per operator, sink and flow, over whole benchmark tables.

Doubles are rounded because the order of additions is open, times and whole
numbers or flags that may be NULL are given as text, and everything computed has
a name, so that any engine can be compared.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierflow import operators as op
from tierflow import store
from tierflow.functions import LOCAL_ZONE
from tierflow.operators.hourly import hours_by_union
from tierflow.plans import flows
from tierflow.plans.gold import TABLES, gold_wide, publish_views
from tierflow.session import configure, shared_dir
from tierflow.sinks import (
    append,
    create_if_missing,
    current_mark,
    insert_if_absent,
    overwrite_partitions,
    put_load,
    register,
    replace_distinct,
    replace_version,
)
from tierflow.sources import (
    ARRIVED,
    LOAD,
    Spec,
    control_table,
    event_stream,
    in_catalog,
    load_specs,
    read_dimension,
    read_table,
    remembered_schema,
    snapshot,
)
from tierflow.streaming import drain, ingest_events
from tierflow.workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]

EVENT = ("id", "time", "node_id", "event_type", "value", "date")
SPLIT = ("2024-01-10", "2024-01-20")
# Ends of three scheduled loads, the first of which starts where the calendar does.
LOADS = ("1995-03-01T12:00:00", "1995-06-15T08:30:00", "1995-09-01T00:00:00")
CALENDAR = "19950101"
# Measures of the wide table that are not summed.
HOW = {"vp1": "avg", "vp2": "max", "cp1": "min", "pfp3": "avg", "iaepd1": "count", "eaepd3": "avg", "temperature": "max"}


# --- scans ---------------------------------------------------------------


def full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection of a source table without a delta column."""
    return _text_times(_orders(spark, sf_dir, delta=None), "o_orderdate")


def bounded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table within a back-fill window, filter pushed down."""
    return _text_times(_orders(spark, sf_dir, delta="o_orderdate"), "o_orderdate")


def timestamps_as_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared timestamps as text, other columns untouched."""
    return op.stringify_timestamps(
        t.raw_events(spark, sf_dir).select("id", "time", "node_id"), {"id": "integer", "time": "timestamp"}
    )


def events_localized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local time, date and hour of every event."""
    events = t.silver_events(spark, sf_dir)
    return _events(events, *EVENT).withColumn("hour", F.substring("time", 12, 2).cast("int"))


def date_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table read within a date range."""
    return _events(op.between_dates(_stored_events(spark, sf_dir), "2024-01-05", "2024-01-25"), *EVENT)


def batch_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct dates of all events."""
    return op.batch_dates(t.silver_events(spark, sf_dir))


def rows_on_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items shipped on a date on which a finished order was placed."""
    orders = t.load(spark, sf_dir, "orders").filter("o_orderstatus = 'F' AND o_totalprice > 300000")
    dates = op.batch_dates(orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")))
    items = t.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("date")
    )
    return op.in_dates(items, dates)


# --- dimension and event tables ------------------------------------------


def dimension_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping snapshots of a dimension, replaced by their distinct rows
    (S5, K1, K4, A5): changed rows keep both versions."""
    configure(spark)
    root = shared_dir(spark, "dimension")
    first = t.load(spark, sf_dir, "customer")
    second = first.withColumn("c_acctbal", F.when(F.col("c_acctbal") < 0, 0.0).otherwise(F.col("c_acctbal")))
    for part in (first, second):
        append(part, f"{root}/bronze")
    replace_distinct(read_dimension(spark, f"{root}/bronze"), f"{root}/silver")
    return spark.read.schema(first.schema).parquet(f"{root}/silver")


def insert_if_absent_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches; the first write of a key wins."""
    early, late = _batches(spark, sf_dir)
    return _inserted(spark, [early, _with_copies(late)])


def insert_if_absent_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with copies inside a batch kept (Q1)."""
    early, late = _batches(spark, sf_dir)
    return _inserted(spark, [early, _with_copies(late)], dedupe_batch=False)


def insert_if_absent_null_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where a third or so of the rows have no key: all of those stay (Q2)."""
    return _as_text(_inserted(spark, _keyless_batches(spark, sf_dir)), "id")


def insert_if_absent_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys looked up on the batch's dates only."""
    return _inserted(spark, list(_batches(spark, sf_dir)), scope="partition")


def insert_if_absent_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys looked up in the key index (K3, J2). It is built for the second batch, after the first
    was stored without it, and brought up to date for the third, which is the second again."""
    configure(spark)
    path = shared_dir(spark, "indexed")
    early, late = _batches(spark, sf_dir)
    insert_if_absent(early, path)
    for _ in range(2):
        insert_if_absent(_with_copies(late), path, index=f"{path}-index")
    return _rounded(_events(snapshot(spark, path, early.schema), *EVENT), ["value"])


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drains of overlapping raw files."""
    configure(spark)
    root = shared_dir(spark, "stream")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    raw = op.stringify_timestamps(t.raw_events(spark, sf_dir), {"time": "timestamp"})
    parts = [raw.filter(F.col("time") < SPLIT[1]), raw.filter(F.col("time") >= SPLIT[0])]
    for part in parts:
        append(part, bronze)
        schema = remembered_schema(spark, bronze, f"{root}/schema")
        events = event_stream(spark, bronze, schema)
        drain(ingest_events(events, silver, f"{root}/checkpoint"))
    return _events(snapshot(spark, silver, events.drop(ARRIVED).schema), *EVENT)


def stream_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drain that is lost inside its first batch, after the batch's rows were stored and before
    it counted as done, and a second one on the same checkpoint, which finds a later load
    as well (T3, K6, Q2)."""
    configure(spark)
    root = shared_dir(spark, "recovery")
    early, late = (_raw(part) for part in _keyless_batches(spark, sf_dir))

    def lost(batch_id: int, rows: int) -> None:
        raise RuntimeError(f"lost in batch {batch_id}")

    put_load(early, f"{root}/bronze", uuid.uuid4().hex)
    with contextlib.suppress(RuntimeError):
        _drained(spark, root, on_batch=lost)
    put_load(late, f"{root}/bronze", uuid.uuid4().hex)
    schema = _drained(spark, root)
    return _as_text(_rounded(_events(snapshot(spark, f"{root}/silver", schema), *EVENT), ["value"]), "id")


def event_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each raw load, told by the name of the file they came in, and the moments at which
    they were stored: one for each micro-batch (X4, X5)."""
    configure(spark)
    root = shared_dir(spark, "lineage")
    for name, part in zip(("early", "late"), _batches(spark, sf_dir), strict=True):
        put_load(_raw(part).coalesce(1), f"{root}/bronze", name)
        schema = _drained(spark, root)
    load = F.regexp_extract("_filename", f"/{LOAD}=([^/]+)/[^/]+$", 1).alias("load")
    return snapshot(spark, f"{root}/silver", schema).groupBy(load).agg(
        F.count(F.lit(1)).alias("stored"), F.count_distinct("_filename").alias("files"), F.count_distinct("_ingested_at").alias("moments")
    )


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each drain of the event job stored, as it reports them, and the dates it
    registered, beside those of the registered table (A7, E2, K7)."""
    configure(spark)
    root, database = shared_dir(spark, "counts"), f"tierflow_{uuid.uuid4().hex}"
    previous = spark.catalog.currentDatabase()
    told = []
    try:
        for name, part in zip(("early", "late"), _batches(spark, sf_dir), strict=True):
            raw = _raw(part)
            spec = _spec(root, database, "readings", raw)
            put_load(raw, spec.bronze_path, name)
            rows = flows.events_to_silver(spark, spec, index=True)
            told.append((name, int(rows), len(rows.partitions)))
    finally:
        spark.catalog.setCurrentDatabase(previous)
    counted = spark.createDataFrame(told, "load string, stored long, dates long")
    load = F.regexp_extract("_filename", f"/{LOAD}=([^/]+)/[^/]+$", 1).alias("load")
    held = in_catalog(spark, database, "readings").groupBy(load).agg(F.count(F.lit(1)).alias("held"))
    return counted.join(held, "load")


# --- hourly aggregates and joins -----------------------------------------


def hourly_sum_electrical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly sums of the electrical measures."""
    return _rounded(op.hourly_sum(t.electrical(t.silver_events(spark, sf_dir)), op.ELECTRICAL), op.ELECTRICAL)


def hourly_sum_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly sums of the energy measures (A2)."""
    return _rounded(op.hourly_sum(t.energy(t.silver_events(spark, sf_dir)), op.ENERGY), op.ENERGY)


def hourly_sum_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over the largest table, per supplier and day (A1)."""
    items = t.load(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("node_id"),
        F.col("l_shipdate").alias("time"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        "l_quantity",
        "l_extendedprice",
    )
    measures = ("l_quantity", "l_extendedprice")
    return _rounded(op.hourly_sum(items, measures), measures)


def hourly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly mean temperature (A3)."""
    return _rounded(op.hourly_avg(t.temperature(t.silver_events(spark, sf_dir))), ["temperature"], 6)


def state_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which states occurred in which hour."""
    return op.state_flags(t.state(t.silver_events(spark, sf_dir)))


def node_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with a meter."""
    return _as_text(op.node_dim(t.nodes(spark, sf_dir), t.meters(spark, sf_dir)), "archived")


def inner_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours with both kinds of sums."""
    events = t.silver_events(spark, sf_dir)
    pair = op.inner_hourly(
        op.hourly_sum(t.electrical(events), ["vp1"]), op.hourly_sum(t.energy(events), ["iaepd1"])
    )
    return _rounded(pair, ["vp1", "iaepd1"])


def left_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours with flags and temperature where known."""
    events = t.silver_events(spark, sf_dir)
    hours = op.hourly_sum(t.electrical(events), ["vp1"])
    hours = op.left_hourly(hours, op.state_flags(t.state(events)))
    hours = op.left_hourly(hours, op.hourly_avg(t.temperature(events)))
    return _as_text(_rounded(_rounded(hours, ["vp1"]), ["temperature"], 6), *op.FLAGS)


def hours_with_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours with node attributes where the node is known."""
    hours = op.hourly_sum(t.electrical(t.silver_events(spark, sf_dir)), ["vp1"])
    dim = op.node_dim(t.nodes(spark, sf_dir), t.meters(spark, sf_dir))
    return _as_text(_rounded(op.with_nodes(hours, dim), ["vp1"]), "archived")


def gold_wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide hourly table of a month."""
    return _wide(gold_wide(t.silver_tables(spark, sf_dir), *t.MONTH))


def gold_wide_by_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table from a single aggregation."""
    s = t.silver_tables(spark, sf_dir).within(*t.MONTH)
    dim = op.node_dim(s.nodes, s.meters)
    return _wide(op.wide_hourly(s.electrical, s.energy, s.state, s.temperature, dim, hours_by_union))


def gold_wide_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table with means, extremes and counts of some measures (A1-A3, Q19)."""
    return _wide(gold_wide(t.silver_tables(spark, sf_dir), *t.MONTH, how=HOW))


def gold_from_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intermediate relations used from SQL."""
    v = publish_views(t.silver_tables(spark, sf_dir), *t.MONTH)
    return spark.sql(f"""
        SELECT x.node_id, x.date, x.hour, d.category,
               round(coalesce(x.vp1, 0) + coalesce(y.iaepd1, 0), 4) AS total,
               coalesce(s.Ind_Shutdown, -1) AS Ind_Shutdown,
               round(coalesce(w.temperature, -1), 6) AS Temperature
        FROM {v['electrical']} x
        JOIN {v['energy']} y USING (node_id, date, hour)
        LEFT JOIN {v['state']} s USING (node_id, date, hour)
        LEFT JOIN {v['temperature']} w USING (node_id, date, hour)
        LEFT JOIN {v['nodes']} d ON d.node_id = x.node_id""")


# --- sinks, catalog, bookkeeping -----------------------------------------


def gold_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month is stored, then some dates are recomputed with other values:
    only those partitions change (K5, Q20)."""
    configure(spark)
    path = shared_dir(spark, "gold")
    hours = op.hourly_sum(t.electrical(t.silver_events(spark, sf_dir)), ["vp1"])
    overwrite_partitions(hours, path)
    again = op.between_dates(hours, *SPLIT).withColumn("vp1", -F.col("vp1"))
    overwrite_partitions(again, path)
    return _rounded(snapshot(spark, path, hours.schema), ["vp1"])


def registered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table read by name: created empty, filled, registered."""
    configure(spark)
    path = shared_dir(spark, "registered")
    events = t.silver_events(spark, sf_dir)
    create_if_missing(spark, path, events.schema)
    insert_if_absent(events, path)
    name = f"tierflow_{uuid.uuid4().hex}"
    register(spark, name, "events", path, events.schema, "date", use=False)
    return _events(in_catalog(spark, name, "events"), *EVENT)


def registered_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered table that grows: later partitions are told to the catalog as the sink returns
    them, without a look at the folder (K7)."""
    configure(spark)
    path, name = shared_dir(spark, "steps"), f"tierflow_{uuid.uuid4().hex}"
    for batch in _batches(spark, sf_dir):
        rows = insert_if_absent(batch, path)
        register(spark, name, "events", path, batch.schema, "date", use=False, partitions=rows.partitions)
    return _rounded(_events(in_catalog(spark, name, "events"), *EVENT), ["value"])


def dimension_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension read by name after it was replaced once, and once more by a run that failed
    while it wrote: the last complete version (K4, A5)."""
    configure(spark)
    root, name = shared_dir(spark, "versions"), f"tierflow_{uuid.uuid4().hex}"
    first = t.load(spark, sf_dir, "customer")
    second = first.unionByName(first).withColumn("c_acctbal", F.greatest("c_acctbal", F.lit(0.0)))
    broken = first.withColumn("c_name", F.when(F.col("c_custkey") % 7 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("c_name")))
    for df in (first, second, broken):
        with contextlib.suppress(RuntimeError):
            replace_version(df, root, lambda path: register(spark, name, "customer", path, first.schema, use=False))
    return in_catalog(spark, name, "customer")


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a load, as the sink counts them while it writes."""
    configure(spark)
    path = shared_dir(spark, "count")
    counted = append(t.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), path)
    return spark.read.parquet(path).agg(
        F.lit(counted).cast("bigint").alias("counted"), F.count(F.lit(1)).alias("stored")
    )


def month_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month window of every order date, with the orders in it (D3)."""
    first, last = op.month_bounds(F.col("o_orderdate"))
    orders = t.load(spark, sf_dir, "orders").select(first.alias("first_day"), last.alias("last_day"))
    return orders.groupBy("first_day", "last_day").agg(F.count(F.lit(1)).alias("orders"))


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest mark per ingest, each order being one run of the ingest named by
    its priority, and the look-back window from there (K9, D2)."""
    runs = t.load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("ingest"),
        F.expr("o_orderdate - INTERVAL 3 DAYS").alias("lo"),
        F.col("o_orderdate").alias("hi"),
        F.col("o_orderkey").alias("run_ts"),
    )
    return _text_times(op.latest_marks(runs), "lo", "hi")


def scheduled_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three scheduled loads of the orders, each from where the one before ended. The mark of the
    second is lost once and the load repeated at a later time: its window and its rows stay the
    same (K1, K9, D1, D2, Q8, Q26)."""
    root = shared_dir(spark, "loads")
    spec = Spec(
        ingest="orders",
        db="",
        table="orders.parquet",
        columns={"o_orderkey": "bigint", "o_orderdate": "timestamp"},
        delta="o_orderdate",
        start_date=CALENDAR,
        end_date=None,
        bronze_root=f"{root}/bronze",
        silver_root=f"{root}/silver",
        gold_root=f"{root}/gold",
        source_format="parquet",
        source_options={"path": sf_dir},
    )
    for k, now in enumerate(LOADS):
        flows.source_to_bronze(spark, spec, now=now)
        if k == 1:
            number = current_mark(spark, spec.marks_path, spec.ingest).number
            store.remove(spark, f"{spec.marks_path}/ingest={spec.ingest}/{number:012d}.json")
            flows.source_to_bronze(spark, spec, now=LOADS[2])
    return spark.read.parquet(spec.bronze_path).select(F.col(LOAD).alias("load"), "o_orderkey", F.substring("o_orderdate", 1, 10).alias("ordered_on"))


def control_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control documents as a table: an ingest for each nation, a connector for each region."""
    configure(spark)
    root = shared_dir(spark, "control")
    regions = {r["r_regionkey"]: r["r_name"] for r in t.load(spark, sf_dir, "region").collect()}
    ingests = {}
    for n in t.load(spark, sf_dir, "nation").collect():
        source = {
            "db": regions[n["n_regionkey"]],
            "table": n["n_name"],
            "columns": {"id": "integer", f"k{n['n_nationkey']}": "double"},
            "delta_column": f"k{n['n_nationkey']}" if n["n_nationkey"] % 2 else None,
            "calendar": {"start_date": f"2024{1 + n['n_nationkey'] % 12:02d}01"},
            "connector": f"{regions[n['n_regionkey']]}.json",
        }
        ingests[f"nation-{n['n_nationkey']}"] = {"source": source, "sink": {"source": {"format": "cloudFiles"}}}
    connectors = {name: {"format": "jdbc", "options": {"region": str(key)}} for key, name in regions.items()}
    found = control_table(spark, *_written(spark, root, {"root": "/lake", "gold_format": "orc"}, ingests, connectors))
    columns = F.array_join(F.transform(F.map_entries("columns"), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ",")
    return found.select(
        "ingest", "db", "table", columns.alias("columns"), "delta", "start_date", "source_format", F.col("source_options")["region"].alias("region"),
        "bronze_format", "silver_format", "gold_format", "bronze_path", "silver_path", "checkpoint_path", "marks_path",
    )


def source_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs end to end: six source tables through three tiers, as control documents say
    (E1-E5, S9). The tables know nothing of each other up to silver and go there side by side."""
    configure(spark)
    root = shared_dir(spark, "flow")
    database = f"tierflow_{uuid.uuid4().hex}"
    raw = t.raw_events(spark, sf_dir)
    source = {
        "electrical": t.electrical(raw).select("id", "time", "node_id", *op.ELECTRICAL),
        "energy": t.energy(raw).select("id", "time", "node_id", *op.ENERGY),
        "state": t.state(raw).select("id", "time", "node_id", "state"),
        "temperature": t.temperature(raw).select("id", "time", "node_id", "temperature"),
        "nodes": t.nodes(spark, sf_dir),
        "meters": t.meters(spark, sf_dir),
    }
    ingests = {}
    _side_by_side(lambda role: source[role].write.parquet(f"{root}/source/{TABLES[role]}"), source)
    for role, df in source.items():
        delta = {"delta_column": "time"} if "time" in df.columns else {}
        ingests[role] = {"source": {"db": database, "table": TABLES[role], "columns": _declared(df), "connector": "files.json", **delta}}
    connectors = {"files": {"format": "parquet", "options": {"path": f"{root}/source"}}}
    specs = load_specs(spark, *_written(spark, f"{root}/conf", {"root": root}, ingests, connectors))
    previous = spark.catalog.currentDatabase()
    spark.sql(f"CREATE SCHEMA `{database}`")

    def to_silver(spec: Spec) -> None:
        flows.source_to_bronze(spark, spec, backfill=("2024-01-01", "2024-02-01") if spec.delta else None)
        flows.bronze_to_silver(spark, spec, "event" if spec.delta else "dimension")

    try:
        _side_by_side(to_silver, specs.values())
        flows.silver_to_gold(spark, specs["electrical"], "wide_hourly", month=t.MONTH[0])
    finally:
        spark.catalog.setCurrentDatabase(previous)
    return _wide(in_catalog(spark, database, "wide_hourly").select(*op.WIDE_COLUMNS))


QUERIES: dict[str, Query] = {
    "full_scan": full_scan,
    "bounded_scan": bounded_scan,
    "timestamps_as_string": timestamps_as_string,
    "events_localized": events_localized,
    "date_pruned_scan": date_pruned_scan,
    "batch_dates": batch_dates,
    "rows_on_order_dates": rows_on_order_dates,
    "dimension_distinct": dimension_distinct,
    "dimension_versions": dimension_versions,
    "insert_if_absent": insert_if_absent_first,
    "insert_if_absent_raw": insert_if_absent_raw,
    "insert_if_absent_null_ids": insert_if_absent_null_ids,
    "insert_if_absent_by_date": insert_if_absent_by_date,
    "insert_if_absent_indexed": insert_if_absent_indexed,
    "stream_ingest": stream_ingest,
    "stream_recovery": stream_recovery,
    "event_lineage": event_lineage,
    "stream_counts": stream_counts,
    "hourly_sum_electrical": hourly_sum_electrical,
    "hourly_sum_energy": hourly_sum_energy,
    "hourly_sum_lineitem": hourly_sum_lineitem,
    "hourly_avg": hourly_avg,
    "state_flags": state_flags,
    "node_dim": node_dim,
    "inner_hourly": inner_hourly,
    "left_hourly": left_hourly,
    "hours_with_nodes": hours_with_nodes,
    "gold_wide": gold_wide_table,
    "gold_wide_by_union": gold_wide_by_union,
    "gold_wide_mixed": gold_wide_mixed,
    "gold_from_views": gold_from_views,
    "gold_partition_overwrite": gold_partition_overwrite,
    "registered_table": registered_table,
    "registered_in_steps": registered_in_steps,
    "row_count": row_count,
    "month_window": month_window,
    "high_water_mark": high_water_mark,
    "scheduled_loads": scheduled_loads,
    "control_scan": control_scan,
    "source_to_gold": source_to_gold,
}


# --- helpers -------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str, delta: str | None) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    window = op.ingest_window(backfill=("1995-01-01", "19970101"))
    return read_table(spark, "parquet", {"path": sf_dir}, "orders.parquet", columns, delta, window)


def _stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    path = shared_dir(spark, "events")
    events = t.silver_events(spark, sf_dir)
    overwrite_partitions(events, path)
    return snapshot(spark, path, events.schema)


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events as two batches that overlap between the split dates. Values
    of the second are negative, which shows whose row was kept."""
    events = t.silver_events(spark, sf_dir)
    late = events.filter(F.col("time") >= SPLIT[0]).withColumn("value", -F.col("value"))
    return events.filter(F.col("time") < SPLIT[1]), late


def _with_copies(batch: DataFrame) -> DataFrame:
    """Each row again, an hour later and with another value."""
    later = batch.withColumns({"time": F.expr("time + INTERVAL 1 HOUR"), "value": F.col("value") - 1000})
    return batch.unionByName(later)


def _inserted(spark: SparkSession, batches: Sequence[DataFrame], **options) -> DataFrame:
    configure(spark)
    path = shared_dir(spark, "insert")
    for batch in batches:
        insert_if_absent(batch, path, **options)
    return _rounded(_events(snapshot(spark, path, batches[0].schema), *EVENT), ["value"])


def _keyless_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The batches with a key for views and clicks alone."""
    keyless = F.when(F.col("event_type").isin("view", "click"), F.col("id"))
    return [b.withColumn("id", keyless) for b in _batches(spark, sf_dir)]


def _raw(events: DataFrame) -> DataFrame:
    """Events as raw files have them: time as text, in UTC again."""
    utc = F.to_utc_timestamp("time", LOCAL_ZONE)
    return op.stringify_timestamps(events.select("id", utc.alias("time"), "node_id", "event_type", "value"), {"time": "timestamp"})


def _drained(spark: SparkSession, root: str, on_batch=None, **options: str) -> StructType:
    """Drain the raw files under a folder into its silver table, and give the table's schema."""
    schema = remembered_schema(spark, f"{root}/bronze", f"{root}/schema")
    events = event_stream(spark, f"{root}/bronze", schema, options=options)
    drain(ingest_events(events, f"{root}/silver", f"{root}/checkpoint", on_batch=on_batch))
    return events.drop(ARRIVED).schema


def _side_by_side(job: Callable[[Any], None], items: Iterable[Any]) -> None:
    """Run a job for each item at the same time; tasks of one fill the cores that others leave. The
    first failure becomes the caller's, once all have ended."""
    with ThreadPoolExecutor() as pool:
        for done in [pool.submit(job, item) for item in items]:
            done.result()


def _declared(df: DataFrame) -> dict[str, str]:
    return {n: "timestamp" if kind.startswith("timestamp") else kind for n, kind in df.dtypes}


def _written(spark: SparkSession, root: str, environment: dict, ingests: dict[str, dict], connectors: dict[str, dict]) -> tuple[str, str, str]:
    """Control documents in a folder: the environment file and the folders of the others."""
    store.create_new(spark, f"{root}/environment.json", json.dumps(environment))
    for folder, docs in (("ingestion", ingests), ("connectors", connectors)):
        for name, doc in docs.items():
            store.create_new(spark, f"{root}/{folder}/{name}.json", json.dumps(doc, indent=1))
    return f"{root}/environment.json", f"{root}/ingestion", f"{root}/connectors"


def _spec(root: str, database: str, table: str, df: DataFrame) -> Spec:
    return Spec(
        ingest=table,
        db=database,
        table=table,
        columns=_declared(df),
        delta="time",
        start_date=None,
        end_date=None,
        bronze_root=f"{root}/bronze",
        silver_root=f"{root}/silver",
        gold_root=f"{root}/gold",
        source_format="parquet",
        source_options={"path": f"{root}/source"},
    )


def _events(df: DataFrame, *columns: str) -> DataFrame:
    return _text_times(df.select(*columns), "time")


def _text_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in columns})


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _rounded(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _wide(df: DataFrame) -> DataFrame:
    measures = (*op.ELECTRICAL, *op.ENERGY)
    return _as_text(_rounded(_rounded(df, measures), ["Temperature"], 6), "archived")
