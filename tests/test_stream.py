"""Micro-batch ingest: drains, replays, packing and failures."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierflow.sinks import append, put_load
from tierflow.sources import event_stream, remembered_schema, snapshot
from tierflow.streaming import drain, ingest_events
from tierflow.workload import queries

SCHEMA = "id bigint, time string, v int, artificial boolean"


class Tiers:
    def __init__(self, spark, root, **ingest):
        self.spark, self.root, self.ingest = spark, str(root), ingest
        self.progress = []

    def land(self, *rows):
        df = self.spark.createDataFrame([(i, t, v, False) for i, t, v in rows], SCHEMA)
        append(df.coalesce(1), f"{self.root}/bronze")

    def drain(self, checkpoint="checkpoint", **options):
        schema = remembered_schema(self.spark, f"{self.root}/bronze", f"{self.root}/schema")
        events = event_stream(self.spark, f"{self.root}/bronze", schema, options=options)
        self.schema = events.drop("_arrived").schema
        q = ingest_events(events, f"{self.root}/silver", f"{self.root}/{checkpoint}", **self.ingest)
        drain(q)
        return len([p for p in q.recentProgress if p["numInputRows"]])

    def rows(self):
        df = snapshot(self.spark, f"{self.root}/silver", self.schema)
        return sorted(((r["id"], r["v"], r["date"]) for r in df.collect()), key=repr)


DAY = "2024-01-02 12:00:00"
D = "2024-01-02"


def test_drains(spark, tmp_path):
    t = Tiers(spark, tmp_path)
    t.land((1, DAY, 1), (2, "2024-01-02 04:00:00", 2), (None, DAY, 3), (5, None, 9))
    assert t.drain() == 1
    first = t.rows()
    assert first == sorted([(1, 1, D), (2, 2, "2024-01-01"), (None, 3, D), (5, 9, None)], key=repr)
    assert t.drain() == 0 and t.rows() == first
    t.land((1, DAY, 7), (3, DAY, 4), (2, "2024-02-01 12:00:00", 8), (5, DAY, 1))
    assert t.drain() == 1
    assert t.rows() == sorted([*first, (3, 4, D)], key=repr)


def test_silver_columns(spark, tmp_path):
    t = Tiers(spark, tmp_path)
    t.land((1, DAY, 1))
    t.drain()
    df = snapshot(spark, f"{t.root}/silver", t.schema)
    assert set(df.columns) == {"id", "time", "v", "date", "_ingested_at", "_filename"}
    row = df.first()
    assert "/bronze/part-" in row["_filename"] and row["_ingested_at"] is not None


def test_replay_of_everything_changes_nothing(spark, tmp_path):
    """A lost checkpoint delivers every file again, keyless rows included."""
    t = Tiers(spark, tmp_path)
    t.land((1, DAY, 1), (None, DAY, 2), (None, None, 3))
    t.land((2, DAY, 1), (None, DAY, 2))
    t.drain(maxFilesPerTrigger="1")
    before = t.rows()
    assert len(before) == 5
    t.drain(checkpoint="another")
    assert t.rows() == before


@pytest.mark.parametrize("per_trigger", ["1", "2", "100"])
def test_packing(spark, tmp_path, per_trigger):
    """Copies in one batch and over several batches give the same table."""
    t = Tiers(spark, tmp_path)
    for n in range(4):
        t.land(*((i, f"2024-01-0{1 + n} 12:00:00", n) for i in range(n, n + 3)))
    t.drain(maxFilesPerTrigger=per_trigger)
    rows = t.rows()
    assert [r[0] for r in rows] == list(range(6))
    assert [r[1] for r in rows] == [0, 0, 0, 1, 2, 3]


@pytest.mark.parametrize("per_trigger", ["1", "2", "100"])
def test_first_to_arrive_wins_however_batches_are_cut(spark, tmp_path, per_trigger):
    """Also when the copy with the later time landed first."""
    t = Tiers(spark, tmp_path)
    for v, day in enumerate((5, 2, 9)):
        t.land((1, f"2024-01-{day:02d} 12:00:00", v), (10 + v, DAY, v))
    t.drain(maxFilesPerTrigger=per_trigger)
    assert t.rows()[0] == (1, 0, "2024-01-05") and len(t.rows()) == 4


def test_copies_can_be_kept(spark, tmp_path):
    t = Tiers(spark, tmp_path, dedupe_batch=False)
    t.land((1, DAY, 1), (1, DAY, 1))
    t.drain()
    assert len(t.rows()) == 2
    t.land((1, DAY, 1))
    t.drain()
    assert len(t.rows()) == 2


def test_many_late_days(spark, tmp_path):
    t = Tiers(spark, tmp_path, scope="partition")
    t.land(*((i, f"2023-{1 + i % 12:02d}-15 12:00:00", i) for i in range(24)))
    t.drain()
    t.land(*((i, f"2023-{1 + i % 12:02d}-15 12:00:00", -1) for i in range(36)))
    t.drain()
    assert [r[1] for r in sorted(t.rows())] == list(range(24)) + [-1] * 12


def test_not_a_stream(spark, tmp_path):
    with pytest.raises(RuntimeError, match="Error writing event data to the Silver layer, error:"):
        ingest_events(spark.range(3), str(tmp_path / "s"), str(tmp_path / "c"))


def test_failure_in_a_batch_reaches_the_caller(spark, tmp_path):
    t = Tiers(spark, tmp_path)
    t.land((1, "not a time", 1))
    with pytest.raises(RuntimeError, match="Error writing event data to the Silver layer, error:"):
        t.drain()


def test_drift_is_refused_before_the_stream_starts(spark, tmp_path):
    t = Tiers(spark, tmp_path)
    t.land((1, DAY, 1))
    t.drain()
    events = event_stream(spark, f"{t.root}/bronze", spark.read.parquet(f"{t.root}/bronze").schema)
    with pytest.raises(RuntimeError, match="unknown column more"):
        ingest_events(events.withColumn("more", F.lit(1)), f"{t.root}/silver", f"{t.root}/c2")


@pytest.mark.parametrize("days", [30, 4000, 18000])
def test_files_with_an_old_timestamp_are_not_skipped(spark, tmp_path, days):
    t = Tiers(spark, tmp_path)
    t.land((1, DAY, 1))
    t.drain()
    before = set(Path(t.root, "bronze").glob("*.parquet"))
    t.land((2, DAY, 2))
    for f in set(Path(t.root, "bronze").glob("*.parquet")) - before:
        long_ago = f.stat().st_mtime - days * 86400
        os.utime(f, (long_ago, long_ago))
    t.drain()
    assert [r[0] for r in t.rows()] == [1, 2]


def test_new_column_in_a_file_with_an_old_timestamp(spark, tmp_path):
    t = Tiers(spark, tmp_path)
    t.land((1, DAY, 1))
    t.drain()
    before = set(Path(t.root, "bronze").glob("*.parquet"))
    wider = spark.createDataFrame([(2, DAY, 2, False, 7)], SCHEMA + ", more int")
    append(wider.coalesce(1), f"{t.root}/bronze")
    for f in set(Path(t.root, "bronze").glob("*.parquet")) - before:
        os.utime(f, (1.6e9, 1.6e9))
    with pytest.raises(ValueError, match=r"columns \['more'\]"):
        t.drain()


def fails_at(wanted):
    def failing(batch_id, rows):
        if batch_id == wanted:
            raise RuntimeError("lost after storing")

    return failing


@pytest.mark.parametrize("lost", [0, 1, 2])
def test_a_batch_lost_after_storing_is_delivered_again(spark, tmp_path, lost):
    """Keyed and keyless rows end up as in a drain without a fault."""
    tables = []
    for name, fault in (("whole", None), ("lost", fails_at(lost))):
        t = Tiers(spark, tmp_path / name, on_batch=fault)
        t.land((1, DAY, 1), (None, DAY, 2), (None, DAY, 2), (None, None, 3))
        t.land((1, DAY, 5), (2, DAY, 1), (None, DAY, 2))
        t.land((3, DAY, 1), (None, DAY, 9))
        if fault:
            with pytest.raises(RuntimeError, match="lost after storing"):
                t.drain(maxFilesPerTrigger="1")
        t.ingest = {}
        t.drain(maxFilesPerTrigger="1")
        tables.append(t.rows())
    assert tables[0] == tables[1] and len(tables[0]) == 8


def test_rows_of_each_batch_are_told(spark, tmp_path):
    told = {}
    t = Tiers(spark, tmp_path, on_batch=told.__setitem__, index=str(tmp_path / "index"))
    t.land((1, DAY, 1), (2, "2024-02-01 12:00:00", 1))
    t.land((1, DAY, 5), (3, None, 1))
    t.drain(maxFilesPerTrigger="1")
    assert told == {0: 2, 1: 1}
    assert [told[k].partitions for k in (0, 1)] == [{D, "2024-02-01"}, {D, None}]


@pytest.mark.parametrize("per_trigger", ["1", "2", "100"])
def test_one_copy_survives_among_files_of_one_time(spark, tmp_path, per_trigger):
    """Which one is open where a batch ends between them; in one batch it is the first name."""
    t = Tiers(spark, tmp_path)
    for v in range(5):
        t.land((1, DAY, v), (10 + v, DAY, v))
    files = sorted(Path(t.root, "bronze").glob("*.parquet"))
    for f in files:
        os.utime(f, (1.7e9, 1.7e9))
    t.drain(maxFilesPerTrigger=per_trigger)
    rows = t.rows()
    assert [r[0] for r in rows] == [1, 10, 11, 12, 13, 14]
    if per_trigger == "100":
        first = spark.read.parquet(str(files[0])).filter("id = 1").first()["v"]
        assert rows[0][1] == first


def test_raw_files_in_the_folders_of_loads(spark, tmp_path):
    t = Tiers(spark, tmp_path)
    t.land((1, DAY, 1))
    df = spark.createDataFrame([(2, DAY, 2, False), (None, DAY, 3, False)], SCHEMA)
    put_load(df, f"{t.root}/bronze", "20240102")
    t.drain()
    assert t.rows() == sorted([(1, 1, D), (2, 2, D), (None, 3, D)], key=repr)
    assert "_load" not in t.schema.names
    put_load(df, f"{t.root}/bronze", "20240102")
    t.drain()
    assert [r for r in t.rows() if r[0] is not None] == [(1, 1, D), (2, 2, D)]


def test_loads_of_a_recovery_are_stored_by_many_tasks(spark, monkeypatch):
    seen = []

    def put(df, *place):
        seen.append(df.rdd.getNumPartitions())
        raise InterruptedError

    monkeypatch.setattr(queries, "put_load", put)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        with pytest.raises(InterruptedError):
            queries.stream_recovery(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] > 1
