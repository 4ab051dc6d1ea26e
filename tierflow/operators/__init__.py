from tierflow.operators.bitmaps import bitmaps, found_keys, merged
from tierflow.operators.bounds import Window, ingest_window, latest_marks, literal, month_bounds, month_window, next_mark
from tierflow.operators.dates import batch_dates, between_dates, date_list, in_dates
from tierflow.operators.events import localize_events, stringify_timestamps
from tierflow.operators.hourly import (
    AGGREGATES,
    ELECTRICAL,
    ENERGY,
    FLAGS,
    KEYS,
    WIDE_COLUMNS,
    hourly,
    hourly_avg,
    hourly_sum,
    hours_by_join,
    hours_by_union,
    inner_hourly,
    left_hourly,
    node_dim,
    state_flags,
    wide_hourly,
    wide_projection,
    with_nodes,
)
from tierflow.operators.keys import KeyProfile, absent_rows, first_per_key, key_counts, key_profile

__all__ = [name for name in dir() if not name.startswith("_")]
