"""Benchmark tables in the roles of the pipeline's tables.

`events` stands for every event table. Its event types say which rows belong
to which one; the types overlap, so that the tables share hours:

=============  =======================  =================================
role           rows of types            columns
=============  =======================  =================================
electrical     click, view, error       k * value (NULL for one pair)
energy         view, purchase, click    value + k
temperature    signup                   value
state          purchase, error, click   a text per type
=============  =======================  =================================

`customer` stands for the nodes and `supplier` for the meters; only some nodes
have a meter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators import ELECTRICAL, ENERGY, localize_events
from tierflow.plans.gold import SilverTables

# Fixed values of the stand-ins.
MONTH = ("2024-01-01", "2024-01-31")
ELECTRICAL_TYPES = ("click", "view", "error")
ENERGY_TYPES = ("view", "purchase", "click")
TEMPERATURE_TYPES = ("signup",)
STATE_TEXTS = {"purchase": "Grid-connected (metered)", "error": "Shutdown: fault", "click": "charging"}
# Measures without a value in some rows: column -> event type.
GAPS = {"vp2": "error", "eaepd3": "view"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` under the pipeline's column names, still in UTC."""
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("time"),
        F.col("user_id").alias("node_id"),
        "event_type",
        "value",
    )


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return localize_events(raw_events(spark, sf_dir))


def electrical(events: DataFrame) -> DataFrame:
    return _of_types(events, ELECTRICAL_TYPES).withColumns(
        {m: _gap(m, F.col("value") * k) for k, m in enumerate(ELECTRICAL, 1)}
    )


def energy(events: DataFrame) -> DataFrame:
    return _of_types(events, ENERGY_TYPES).withColumns(
        {m: _gap(m, F.col("value") + k) for k, m in enumerate(ENERGY, 1)}
    )


def temperature(events: DataFrame) -> DataFrame:
    return _of_types(events, TEMPERATURE_TYPES).withColumn("temperature", F.col("value"))


def state(events: DataFrame) -> DataFrame:
    text = F.create_map(*(F.lit(x) for pair in STATE_TEXTS.items() for x in pair))
    return _of_types(events, tuple(STATE_TEXTS)).withColumn("state", text[F.col("event_type")])


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").alias("meter_id"),
        F.col("c_mktsegment").alias("category"),
        (F.col("c_acctbal") < 0).alias("archived"),
    )


def meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("meter_id"),
        F.concat(F.lit("type "), F.col("s_nationkey").cast("string")).alias("installation_type"),
    )


def silver_tables(spark: SparkSession, sf_dir: str) -> SilverTables:
    events = silver_events(spark, sf_dir)
    return SilverTables(
        electrical=electrical(events),
        energy=energy(events),
        state=state(events),
        temperature=temperature(events),
        nodes=nodes(spark, sf_dir),
        meters=meters(spark, sf_dir),
    )


def _of_types(events: DataFrame, types: tuple[str, ...]) -> DataFrame:
    return events.filter(F.col("event_type").isin(*types))


def _gap(measure: str, value: Column) -> Column:
    return F.when(F.col("event_type") != GAPS[measure], value) if measure in GAPS else value
