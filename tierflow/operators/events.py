"""Row-wise shaping of event tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions import LOCAL_ZONE, date_key, local_time

# Source bookkeeping columns that silver does not carry.
DROPPED = ("artificial", "recovered")


def stringify_timestamps(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns declared `timestamp` as text, in one projection."""
    declared = [name for name, kind in types.items() if kind == "timestamp"]
    if not declared:
        return df
    return df.withColumns({name: F.col(name).cast("string") for name in declared})


def localize_events(
    df: DataFrame,
    zone: str = LOCAL_ZONE,
    filename: Column | None = None,
) -> DataFrame:
    """Raw events as silver events.

    `time` is shifted to `zone`; `date` follows from the shifted time, so both
    are computed from the same expression in one projection. `filename` is the
    lineage column: file readers pass `_metadata.file_path`, frames that do not
    come from files fall back on `input_file_name()`.
    """
    shifted = local_time("time", zone)
    return df.withColumns(
        {
            "time": shifted,
            "date": date_key(shifted),
            "_ingested_at": F.current_timestamp(),
            "_filename": F.input_file_name() if filename is None else filename,
        }
    ).drop(*DROPPED)
