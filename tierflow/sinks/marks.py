"""High-water marks and the plans of scheduled loads.

Marks of an ingest are numbered files, one per finished load. A load plans its window under
the number of the mark it is going to write, loads, and writes the mark. The store creates
each number once, so that

* a load lost before its mark is repeated with the window it had planned, not with one that
  ends at another now, and so replaces what it had loaded;
* of two loads that started from one mark a single one advances it; the other one raises.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow import store
from tierflow.operators.bounds import Window, next_mark, utc

MARKS = "number long, lo timestamp, hi timestamp, run_ts timestamp"
# Digits of a mark's number, so that names sort as numbers do.
DIGITS = 12


class ConcurrentLoad(RuntimeError):
    """Another load advanced the mark first."""


@dataclass(frozen=True)
class Mark:
    """Where the next load starts; number 0, and no time, before the first one."""

    number: int = 0
    hi: datetime | None = None


def current_mark(spark: SparkSession, path: str, ingest: str) -> Mark:
    """The latest mark of an ingest (K9). Numbers whose writer was lost half-way count, their
    windows do not."""
    number = 0
    for name in reversed(_numbers(spark, _folder(path, ingest))):
        number = max(number, int(name[:DIGITS]))
        if text := store.read_text(spark, f"{_folder(path, ingest)}/{name}"):
            return Mark(number, utc(json.loads(text)["hi"]))
    return Mark(number)


def read_mark(spark: SparkSession, path: str, ingest: str) -> datetime | None:
    """The time of the latest mark of an ingest, or None before its first load (K9)."""
    return current_mark(spark, path, ingest).hi


def record_mark(spark: SparkSession, path: str, ingest: str, window: Window, after: Mark | None = None) -> Mark:
    """Store where the next scheduled load of an ingest starts (K9).

    `after` is the mark the load started from; without it, the latest one. Raises if
    it is not the latest any more.
    """
    after = current_mark(spark, path, ingest) if after is None else after
    mark = Mark(after.number + 1, next_mark(window))
    if not store.create_new(spark, _file(path, ingest, mark.number), _row(mark.number, window.lo, mark.hi)):
        raise ConcurrentLoad(f"{ingest}: mark {mark.number} was written by another load")
    return mark


def planned_window(spark: SparkSession, path: str, ingest: str, after: Mark, window: Window) -> Window:
    """The window of the load that follows a mark: that of an earlier attempt, or else
    `window`, which is noted before anything is loaded."""
    plan = _file(path, ingest, after.number + 1, plans=True)
    if not store.create_new(spark, plan, _row(after.number + 1, window.lo, window.hi)):
        if text := store.read_text(spark, plan):
            row = json.loads(text)
            return Window(utc(row["lo"]), utc(row["hi"]))
        # Its writer was lost before it said which window: nothing was loaded.
        store.remove(spark, plan)
        return planned_window(spark, path, ingest, after, window)
    return window


def all_marks(spark: SparkSession, path: str) -> DataFrame:
    """Every mark of every ingest, for :func:`~tierflow.operators.latest_marks`."""
    return spark.read.schema(f"{MARKS}, ingest string").json(path).withColumn("ingest", F.col("ingest").cast("string"))


def _folder(path: str, ingest: str, plans: bool = False) -> str:
    return f"{path}{'/_plans' if plans else ''}/ingest={ingest}"


def _file(path: str, ingest: str, number: int, plans: bool = False) -> str:
    return f"{_folder(path, ingest, plans)}/{number:0{DIGITS}d}.json"


def _numbers(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in store.names(spark, folder) if n[:DIGITS].isdigit() and n.endswith(".json")]


def _row(number: int, lo: datetime, hi: datetime) -> str:
    row = {"number": number, "lo": lo.isoformat(), "hi": hi.isoformat(), "run_ts": datetime.now(timezone.utc).isoformat()}
    return json.dumps(row) + "\n"
