"""Silver to gold: the wide hourly table of one month."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierflow.operators.dates import between_dates
from tierflow.operators.hourly import ELECTRICAL, ENERGY, hourly_avg, hourly_sum, node_dim, state_flags, wide_hourly
from tierflow.sources.files import in_catalog

# Silver tables the wide table is built from.
TABLES = {
    "electrical": "measurement_electrical",
    "energy": "measurement_electrical_energy",
    "state": "measurement_state",
    "temperature": "measurement_temperature",
    "nodes": "node",
    "meters": "meter_electric",
}
# Names under which SQL users find the intermediate relations.
VIEWS = {
    "state": "state_t0",
    "temperature": "temperature_t1",
    "nodes": "node_t2",
    "electrical": "electrical_t3",
    "energy": "electrical_energy_t4",
}


@dataclass(frozen=True)
class SilverTables:
    """The six inputs of the wide table."""

    electrical: DataFrame
    energy: DataFrame
    state: DataFrame
    temperature: DataFrame
    nodes: DataFrame
    meters: DataFrame

    @classmethod
    def registered(cls, spark: SparkSession, database: str) -> SilverTables:
        """The inputs as catalog tables."""
        return cls(**{role: in_catalog(spark, database, name) for role, name in TABLES.items()})

    def within(self, first: str, last: str) -> SilverTables:
        """The four event tables cut to a range of dates (F2)."""
        cut = {r: between_dates(getattr(self, r), first, last) for r in ("electrical", "energy", "state", "temperature")}
        return SilverTables(**cut, nodes=self.nodes, meters=self.meters)


def gold_wide(tables: SilverTables, first: str, last: str, how: Mapping[str, str] | None = None) -> DataFrame:
    """The wide hourly table for a range of dates; `how` as in :func:`~tierflow.operators.wide_hourly`."""
    t = tables.within(first, last)
    return wide_hourly(t.electrical, t.energy, t.state, t.temperature, node_dim(t.nodes, t.meters), how=how)


def publish_views(tables: SilverTables, first: str, last: str) -> dict[str, str]:
    """The intermediate relations as temp views, for use from SQL (K8)."""
    t = tables.within(first, last)
    relations = {
        "state": state_flags(t.state),
        "temperature": hourly_avg(t.temperature),
        "nodes": node_dim(t.nodes, t.meters),
        "electrical": hourly_sum(t.electrical, ELECTRICAL),
        "energy": hourly_sum(t.energy, ENERGY),
    }
    for role, relation in relations.items():
        relation.createOrReplaceTempView(VIEWS[role])
    return dict(VIEWS)
