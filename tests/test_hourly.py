"""Hourly aggregates and the wide table on literal rows, and their plans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tierflow.operators import (
    ELECTRICAL,
    ENERGY,
    FLAGS,
    WIDE_COLUMNS,
    hourly,
    hourly_avg,
    hourly_sum,
    hours_by_join,
    hours_by_union,
    node_dim,
    state_flags,
    wide_hourly,
)
from tierflow.plans.gold import SilverTables, gold_wide

BOTH = pytest.mark.parametrize("combine", [hours_by_join, hours_by_union])


def measures(spark, names, rows):
    """Silver rows (node, time, first measure); the other measures are 1."""
    df = spark.createDataFrame(rows, "node_id bigint, time string, m double")
    return _silver(df).select("*", F.col("m").alias(names[0]), *(F.lit(1.0).alias(n) for n in names[1:]))


def texts(spark, rows):
    return _silver(spark.createDataFrame(rows, "node_id bigint, time string, state string"))


def temps(spark, rows):
    return _silver(spark.createDataFrame(rows, "node_id bigint, time string, temperature double"))


def _silver(df):
    return df.withColumns({"time": F.col("time").cast("timestamp"), "date": F.substring("time", 1, 10)})


def dim(spark, nodes, meters):
    return node_dim(
        spark.createDataFrame(nodes, "id bigint, meter_id bigint, category string, archived boolean"),
        spark.createDataFrame(meters, "meter_id bigint, installation_type string"),
    )


NODES = [(1, 10, "home", False), (2, 99, "home", False), (3, 10, "old", True), (4, 11, "x", False), (4, 11, "y", False)]
METERS = [(10, "roof"), (11, "ground")]
T = "2024-01-05 03:10:00"


def wide(spark, combine, electrical=(), energy=(), state=(), temperature=(), how=None):
    df = wide_hourly(
        measures(spark, ELECTRICAL, list(electrical)),
        measures(spark, ENERGY, list(energy)),
        texts(spark, list(state)),
        temps(spark, list(temperature)),
        dim(spark, NODES, METERS),
        combine,
        how,
    )
    assert tuple(df.columns) == WIDE_COLUMNS and len(df.columns) == 37
    return df.orderBy("node_id", "date", "hour", "category").collect()


def test_sum_by_hour(spark):
    rows = [(1, T, 2.0), (1, "2024-01-05 03:59:59", 3.0), (1, "2024-01-05 04:00:00", 5.0), (1, "2024-01-06 03:00:00", 7.0)]
    got = hourly_sum(measures(spark, ELECTRICAL, rows), ELECTRICAL).orderBy("date", "hour").collect()
    assert [(r["date"], r["hour"], r["vp1"], r["pfp3"]) for r in got] == [
        ("2024-01-05", 3, 5.0, 2.0),
        ("2024-01-05", 4, 5.0, 1.0),
        ("2024-01-06", 3, 7.0, 1.0),
    ]


def test_average_skips_missing_values(spark):
    got = hourly_avg(temps(spark, [(1, T, 2.0), (1, T, None), (1, T, 4.0), (2, T, None)])).orderBy("node_id").collect()
    assert [r["temperature"] for r in got] == [3.0, None]


def test_flags(spark):
    rows = [(1, T, "Grid-connected x"), (1, T, "Shutdown"), (2, T, None), (3, T, "???")]
    got = state_flags(texts(spark, rows)).orderBy("node_id").collect()
    assert [tuple(r[f] for f in FLAGS) for r in got] == [(1, 0, 1), (0, 1, 0), (0, 1, 0)]
    assert FLAGS == ("Ind_Grid_Connected", "Ind_Standby", "Ind_Shutdown")


@BOTH
def test_only_hours_with_both_sums(spark, combine):
    later = "2024-01-05 07:00:00"
    got = wide(
        spark,
        combine,
        electrical=[(1, T, 1.0), (1, later, 1.0)],
        energy=[(1, T, 1.0), (2, later, 1.0)],
        state=[(2, T, "Standby")],
        temperature=[(2, T, 5.0)],
    )
    assert [(r["node_id"], r["hour"]) for r in got] == [(1, 3)]


@BOTH
def test_fills(spark, combine):
    r, = wide(spark, combine, electrical=[(1, T, None), (1, T, None)], energy=[(1, T, 4.0)])
    assert (r["vp1"], r["vp2"], r["iaepd1"]) == (0.0, 2.0, 4.0)
    assert [r[f] for f in FLAGS] == [-1, -1, -1] and r["Temperature"] == -1.0


@BOTH
def test_flags_and_temperature_join_in(spark, combine):
    r, = wide(
        spark,
        combine,
        electrical=[(1, T, 1.0)],
        energy=[(1, T, 1.0)],
        state=[(1, T, "Shutdown"), (1, T, "Shutdown"), (1, "2024-01-05 04:00:00", "Standby")],
        temperature=[(1, T, -1.0), (1, T, -2.0)],
    )
    assert [r[f] for f in FLAGS] == [0, 0, 1] and r["Temperature"] == -1.5


@BOTH
def test_node_attributes(spark, combine):
    ids = (1, 2, 3, 4, 5)
    got = wide(spark, combine, electrical=[(i, T, 1.0) for i in ids], energy=[(i, T, 1.0) for i in ids])
    assert [(r["node_id"], r["category"], r["archived"], r["installation_type"]) for r in got] == [
        (1, "home", False, "roof"),
        (2, None, None, None),  # node without a known meter
        (3, "old", True, "roof"),  # archived nodes stay
        (4, "x", False, "ground"),  # one row per version
        (4, "y", False, "ground"),
        (5, None, None, None),  # unknown node
    ]


@BOTH
def test_missing_keys_drop_out(spark, combine):
    rows = [(None, T, 1.0), (1, None, 1.0), (1, T, 1.0)]
    got = wide(spark, combine, electrical=rows, energy=rows, state=[(None, T, "Shutdown")])
    assert [r["node_id"] for r in got] == [1]


@BOTH
def test_hot_node_and_hour(spark, combine):
    """A third of all rows in one group: same sums, and no row is lost."""
    rows = [(1, T, 1.0)] * 3000 + [(i, T, 1.0) for i in range(2, 6002)]
    got = wide(spark, combine, electrical=rows, energy=rows[:3002])
    assert [(r["node_id"], r["vp1"], r["iaepd1"]) for r in got] == [(1, 3000.0, 3000.0), (2, 1.0, 1.0), (3, 1.0, 1.0)]


# --- plans -----------------------------------------------------------------


def stored(spark, tmp_path):
    """Partitioned silver tables, large enough to be worth pruning."""
    one = [(n, f"2024-0{m}-05 0{h}:00:00", 1.0) for n in range(20) for m in (1, 2) for h in range(3)]
    frames = {
        "electrical": measures(spark, ELECTRICAL, one).withColumn("unused", F.lit("x")),
        "energy": measures(spark, ENERGY, one),
        "state": texts(spark, [(n, t, "Standby") for n, t, _ in one]),
        "temperature": temps(spark, one),
        "nodes": spark.createDataFrame(NODES, "id bigint, meter_id bigint, category string, archived boolean"),
        "meters": spark.createDataFrame(METERS, "meter_id bigint, installation_type string"),
    }
    for name, df in frames.items():
        writer = df.write.partitionBy("date") if "date" in df.columns else df.write
        writer.parquet(f"{tmp_path}/{name}")
    return SilverTables(**{n: spark.read.parquet(f"{tmp_path}/{n}") for n in frames})


def plan_without_adaptivity(spark, build):
    """Physical plan as laid out before anything is measured, joins by shuffle."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        return build()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_one_exchange_per_aggregate(spark, tmp_path):
    t = stored(spark, tmp_path).within("2024-01-01", "2024-01-31")
    plan = plan_without_adaptivity(spark, lambda: hours_by_join(t.electrical, t.energy, t.state, t.temperature))
    assert plan.count("Exchange hashpartitioning") == 4
    plan = plan_without_adaptivity(spark, lambda: hours_by_union(t.electrical, t.energy, t.state, t.temperature))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_month_prunes_partitions_and_columns(spark, tmp_path):
    t = stored(spark, tmp_path)
    plan = plan_without_adaptivity(spark, lambda: gold_wide(t, "2024-01-01", "2024-01-31"))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "date#" in line]
    assert len(scans) == 4
    for scan in scans:
        assert re.search(r"PartitionFilters: \[.*date#\d+ >= 2024-01-01.*date#\d+ <= 2024-01-31", scan)
        assert "unused" not in scan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan and "Python" not in plan


def test_small_node_table_is_broadcast_only_when_measured_small(spark, tmp_path):
    t = stored(spark, tmp_path)
    df = gold_wide(t, "2024-01-01", "2024-01-31")
    df.collect()
    shuffled = plan_without_adaptivity(spark, lambda: gold_wide(t, "2024-01-01", "2024-01-31"))
    assert "BroadcastExchange" not in shuffled
    assert df.count() == gold_wide(t, "2024-01-01", "2024-01-31").count() > 0


def test_aggregate_of_each_measure(spark):
    rows = [(1, T, 2.0), (1, T, None), (1, T, 5.0), (2, T, None)]
    for how, expected in {"sum": [7.0, None], "avg": [3.5, None], "min": [2.0, None], "max": [5.0, None], "count": [2, 0]}.items():
        got = hourly(measures(spark, ELECTRICAL, rows), ["vp1", "vp2"], {"vp1": how}).orderBy("node_id").collect()
        assert [r["vp1"] for r in got] == expected and [r["vp2"] for r in got] == [3.0, 1.0]
    with pytest.raises(ValueError, match="no aggregate is called median"):
        hourly(measures(spark, ELECTRICAL, rows), ["vp1"], {"vp1": "median"})


@BOTH
def test_wide_table_with_other_aggregates(spark, combine):
    how = {"vp1": "avg", "iaepd1": "count", "temperature": "min"}
    rows = [(1, T, 2.0), (1, T, 4.0), (2, T, 1.0)]
    got = wide(spark, combine, rows, [(1, T, None), (1, T, 3.0), (2, T, None)], temperature=[(1, T, 9.0), (1, T, 7.0)], how=how)
    assert [(r["vp1"], r["vp2"], r["iaepd1"], r["Temperature"]) for r in got if r["category"] == "home"] == [(3.0, 2.0, 1, 7.0)]
    counted = wide(spark, combine, rows, [(1, T, 1.0), (2, T, 1.0)], temperature=[(1, T, None)], how={"temperature": "count"})
    # An hour whose temperatures are unknown has none; an hour without any is unknown.
    assert [r["Temperature"] for r in counted] == [0, -1]
    with pytest.raises(ValueError, match="no measure is called vq1"):
        wide(spark, combine, how={"vq1": "avg"})


def test_other_aggregates_cost_no_exchange(spark):
    e = measures(spark, ELECTRICAL, [(1, T, 2.0)])
    args = (e, measures(spark, ENERGY, [(1, T, 2.0)]), texts(spark, []), temps(spark, []))
    plans = [hours_by_join(*args, how)._jdf.queryExecution().executedPlan().toString() for how in (None, {"vp1": "avg", "cp1": "max"})]
    assert plans[0].count("hashpartitioning") == plans[1].count("hashpartitioning")
