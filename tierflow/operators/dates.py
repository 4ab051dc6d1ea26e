"""Selections on the `date` partition column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# An IN-list of this many dates (more than 27 years) is still a short literal
# list for the partition pruner; batches beyond it take the join form.
MAX_DATE_LIST = 10_000


def between_dates(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows whose date text lies in [first, last]; prunes partitions (F2)."""
    return df.filter(F.col("date").between(str(first), str(last)))


def batch_dates(df: DataFrame) -> DataFrame:
    """The distinct dates of a frame."""
    return df.select("date").distinct()


def in_dates(df: DataFrame, dates: Sequence[str] | DataFrame) -> DataFrame:
    """Rows on the given dates (F3); a NULL date never matches.

    A list becomes a static partition filter. A frame becomes a semi join,
    which Spark turns into dynamic partition pruning when it pays off.
    """
    if isinstance(dates, DataFrame):
        return df.join(dates.select("date"), "date", "left_semi").select(df.columns)
    return df.filter(F.col("date").isin([d for d in dates if d is not None]))


def date_list(df: DataFrame) -> list[str] | None:
    """The non-NULL dates of a frame on the driver, or None when there are
    more than :data:`MAX_DATE_LIST` (C2)."""
    rows = batch_dates(df.filter(F.col("date").isNotNull())).limit(MAX_DATE_LIST + 1).collect()
    return None if len(rows) > MAX_DATE_LIST else sorted(r["date"] for r in rows)
