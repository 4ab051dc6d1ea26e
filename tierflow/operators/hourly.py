"""Hourly aggregates and the wide hourly table.

Every aggregate groups by the same key columns in the same order. Aggregates
that feed the wide table therefore share one hash partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions import hour_of, operating_state, or_unknown, or_zero, state_flag

KEYS = ("node_id", "date", "hour")

# Measure families, their phases, and output column names.
PHASES = (1, 2, 3)
ELECTRICAL = tuple(f"{family}{phase}" for family in ("vp", "cp", "app", "rpp", "pfp") for phase in PHASES)
ENERGY = tuple(f"{family}{phase}" for family in ("iaepd", "eaepd", "irepd", "erepd") for phase in PHASES)
FLAG_OF_STATE = {"Grid-connected": "Ind_Grid_Connected", "Standby": "Ind_Standby", "Shutdown": "Ind_Shutdown"}
FLAGS = tuple(FLAG_OF_STATE.values())
NODE_COLUMNS = ("category", "archived", "installation_type")
# How the measures of an hour can be put together; NULLs are left out by each.
AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}
# Measures that are not named are summed, but for these.
AVERAGED = ("temperature",)
WIDE_COLUMNS = ("node_id", *NODE_COLUMNS, "date", "hour", *ELECTRICAL, *ENERGY, *FLAGS, "Temperature")


def with_hour(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Grouping keys plus the named columns, nothing else."""
    return df.select("node_id", "date", hour_of("time").alias("hour"), *columns)


def hourly(df: DataFrame, measures: Sequence[str], how: Mapping[str, str] | None = None) -> DataFrame:
    """Each measure per node, date and hour, by its aggregate (A1-A3, Q19): `how` maps measures to
    the names in :data:`AGGREGATES`; those it does not name are summed."""
    return with_hour(df, measures).groupBy(*KEYS).agg(*_aggregates(measures, how))


def hourly_sum(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Sum of each measure per node, date and hour (A1, A2)."""
    return hourly(df, measures, dict.fromkeys(measures, "sum"))


def hourly_avg(df: DataFrame, measure: str = "temperature") -> DataFrame:
    """Mean of one measure per node, date and hour (A3)."""
    return hourly(df, [measure], {measure: "avg"})


def _aggregates(measures: Sequence[str], how: Mapping[str, str] | None) -> list[Column]:
    named = {m: (how or {}).get(m, "avg" if m in AVERAGED else "sum") for m in measures}
    if unknown := sorted(set(named.values()) - AGGREGATES.keys()):
        raise ValueError(f"no aggregate is called {', '.join(unknown)}")
    return [AGGREGATES[name](m).alias(m) for m, name in named.items()]


def _check_measures(how: Mapping[str, str] | None) -> None:
    if unknown := sorted((how or {}).keys() - {*ELECTRICAL, *ENERGY, "temperature"}):
        raise ValueError(f"no measure is called {', '.join(unknown)}")


def state_flags(df: DataFrame, state: str = "state") -> DataFrame:
    """Which states occurred per node, date and hour, one 0/1 column each (A4)."""
    return _flagged(df, state).groupBy(*KEYS).agg(*(F.max(f).alias(f) for f in FLAGS))


def node_dim(nodes: DataFrame, meters: DataFrame) -> DataFrame:
    """Nodes with the installation type of their meter.

    No hint: Spark broadcasts the smaller side when its measured size is under
    `spark.sql.autoBroadcastJoinThreshold`, and shuffles both otherwise.
    """
    return nodes.join(meters.select("meter_id", "installation_type"), "meter_id").select(
        F.col("id").alias("node_id"), "meter_id", "category", "archived", "installation_type"
    )


def inner_hourly(electrical: DataFrame, energy: DataFrame) -> DataFrame:
    """Hours present in both aggregates."""
    return electrical.join(energy, list(KEYS))


def left_hourly(hours: DataFrame, other: DataFrame) -> DataFrame:
    """Hours with what the other aggregate knows about them."""
    return hours.join(other, list(KEYS), "left")


def with_nodes(hours: DataFrame, dim: DataFrame) -> DataFrame:
    """Hours with the attributes of their node, NULL where none matches.

    A node with several versions yields one row per version. No hint, as for
    :func:`node_dim`; past the broadcast threshold the adaptive sort-merge join
    splits the partition of a hot node.
    """
    return hours.join(dim.select("node_id", *NODE_COLUMNS), "node_id", "left")


def wide_projection(hours: DataFrame) -> DataFrame:
    """The 37 output columns with missing values filled."""
    return hours.select(
        "node_id",
        *NODE_COLUMNS,
        "date",
        "hour",
        *(or_zero(m).alias(m) for m in (*ELECTRICAL, *ENERGY)),
        *(or_unknown(f).alias(f) for f in FLAGS),
        or_unknown("temperature").alias("Temperature"),
    )


def hours_by_join(
    electrical: DataFrame,
    energy: DataFrame,
    state: DataFrame,
    temperature: DataFrame,
    how: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per hour from four aggregates joined on the keys.

    Four exchanges, one per aggregate, each of narrow rows that were combined
    map-side; the joins reuse their partitioning and add no exchange.
    """
    hours = inner_hourly(hourly(electrical, ELECTRICAL, how), hourly(energy, ENERGY, how))
    hours = left_hourly(hours, state_flags(state))
    return left_hourly(hours, hourly(temperature, ["temperature"], how))


def hours_by_union(
    electrical: DataFrame,
    energy: DataFrame,
    state: DataFrame,
    temperature: DataFrame,
    how: Mapping[str, str] | None = None,
) -> DataFrame:
    """The result of :func:`hours_by_join` from one aggregation.

    The four tables are stacked with NULLs for the columns they lack, so the
    equi joins on the grouping keys fall together with the grouping: one
    exchange instead of four, and no sorts. Every input row then updates the
    accumulators of all tables, which costs more CPU than the joins save

    Marker columns keep the hours that both sum tables have, and tell those without a
    temperature. NULL keys never join, so they are dropped up front.
    """
    parts = [
        with_hour(electrical, ELECTRICAL).withColumn("_electrical", F.lit(1)),
        with_hour(energy, ENERGY).withColumn("_energy", F.lit(1)),
        _flagged(state, "state"),
        with_hour(temperature, ["temperature"]).withColumn("_temperature", F.lit(1)),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    keyed = stacked.filter(reduce(Column.__and__, (F.col(k).isNotNull() for k in KEYS)))
    return (
        keyed.groupBy(*KEYS)
        .agg(
            *_aggregates((*ELECTRICAL, *ENERGY, "temperature"), how),
            *(F.max(f).alias(f) for f in FLAGS),
            F.max("_temperature").alias("_temperature"),
            F.max("_electrical").alias("_electrical"),
            F.max("_energy").alias("_energy"),
        )
        .filter(F.col("_electrical").isNotNull() & F.col("_energy").isNotNull())
        .withColumn("temperature", F.when(F.col("_temperature").isNotNull(), F.col("temperature")))
        .drop("_electrical", "_energy", "_temperature")
    )


def wide_hourly(
    electrical: DataFrame,
    energy: DataFrame,
    state: DataFrame,
    temperature: DataFrame,
    dim: DataFrame,
    combine=hours_by_join,
    how: Mapping[str, str] | None = None,
) -> DataFrame:
    """The wide hourly table.

    `how` names the aggregates of measures (and of `temperature`) that are not to be summed (and
    averaged), such as the mean of voltages. Inputs are silver rows, already cut to the wanted dates. `combine` is one
    of :func:`hours_by_join` and :func:`hours_by_union`.
    """
    _check_measures(how)
    return wide_projection(with_nodes(combine(electrical, energy, state, temperature, how), dim))


def _flagged(df: DataFrame, state: str) -> DataFrame:
    normal = df.select("node_id", "date", "time", operating_state(state).alias("state"))
    return with_hour(normal, [state_flag("state", name).alias(flag) for name, flag in FLAG_OF_STATE.items()])
