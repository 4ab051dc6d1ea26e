from tierflow.functions.columns import (
    LOCAL_ZONE,
    STATES,
    UNKNOWN,
    date_key,
    hour_of,
    local_time,
    operating_state,
    or_unknown,
    or_zero,
    state_flag,
)

__all__ = [
    "LOCAL_ZONE",
    "STATES",
    "UNKNOWN",
    "date_key",
    "hour_of",
    "local_time",
    "operating_state",
    "or_unknown",
    "or_zero",
    "state_flag",
]
