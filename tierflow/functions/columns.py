"""Column expressions of the pipeline. All stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone of the sensors, the states in order of precedence,
# the state every other text (and NULL) counts as, and the sentinel for
# "nothing known in this hour".
LOCAL_ZONE = "America/Bogota"
STATES = ("Grid-connected", "Standby", "Shutdown")
FALLBACK_STATE = "Standby"
UNKNOWN = -1


def local_time(time: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """UTC time (text or timestamp) as wall-clock time in `zone`."""
    return F.from_utc_timestamp(_col(time), zone)


def date_key(time: Column | str) -> Column:
    """Calendar date as `yyyy-MM-dd` text, the partition key."""
    return F.date_format(_col(time), "yyyy-MM-dd")


def hour_of(time: Column | str) -> Column:
    """Hour of day, 0-23."""
    return F.hour(_col(time))


def operating_state(state: Column | str) -> Column:
    """Free-text state reduced to one of :data:`STATES` by prefix."""
    text = _col(state)
    cases = None
    for name in STATES:
        starts = text.startswith(name)
        cases = F.when(starts, name) if cases is None else cases.when(starts, name)
    return cases.otherwise(FALLBACK_STATE)


def state_flag(state: Column | str, name: str) -> Column:
    """1 where the normalised state equals `name`, else 0."""
    return F.when(_col(state) == name, 1).otherwise(0)


def or_zero(value: Column | str) -> Column:
    """Missing measure as 0."""
    return F.coalesce(_col(value), F.lit(0))


def or_unknown(value: Column | str) -> Column:
    """Missing flag or temperature as -1."""
    return F.coalesce(_col(value), F.lit(UNKNOWN))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
