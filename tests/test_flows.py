"""The jobs: bookkeeping of source loads, both kinds of silver tables, gold."""

from __future__ import annotations

import dataclasses
import json
import threading
import uuid
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierflow.__main__ import main
from tierflow.plans import bronze_to_silver, dimension_to_silver, events_to_silver, flows, source_to_bronze
from tierflow.sinks import ConcurrentLoad, read_mark
from tierflow.sources import Spec, in_catalog
from tierflow.workload import queries

UTC = timezone.utc


@pytest.fixture
def spec(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    yield Spec(
        ingest="readings",
        db=f"t_{uuid.uuid4().hex}",
        table="readings",
        columns={"id": "integer", "time": "timestamp", "v": "integer"},
        delta="time",
        start_date="20240101",
        end_date=None,
        bronze_root=f"{tmp_path}/bronze",
        silver_root=f"{tmp_path}/silver",
        gold_root=f"{tmp_path}/gold",
        source_format="parquet",
        source_options={"path": f"{tmp_path}/source"},
    )
    spark.catalog.setCurrentDatabase(before)


def fill_source(spark, spec, *rows, mode="overwrite"):
    df = spark.createDataFrame([(i, t, v, "x") for i, t, v in rows], "id int, t string, v int, other string")
    df = df.selectExpr("id", "CAST(t AS TIMESTAMP) AS time", "v", "other")
    df.write.mode(mode).parquet(f"{spec.source_options['path']}/{spec.table}")


def bronze_ids(spark, spec):
    return sorted(r["id"] for r in spark.read.parquet(spec.bronze_path).collect())


def test_scheduled_loads_follow_the_mark(spark, spec):
    fill_source(spark, spec, (1, "2023-12-31", 0), (2, "2024-01-01", 0), (3, "2024-01-04 10:00:00", 0))
    load = source_to_bronze(spark, spec, now="2024-01-04T12:00:00")
    assert (load.rows, load.window.lo) == (2, datetime(2024, 1, 1, tzinfo=UTC))
    assert spark.read.parquet(spec.bronze_path).dtypes == [("id", "int"), ("time", "string"), ("v", "int"), ("_load", "string")]
    fill_source(spark, spec, (4, "2024-01-04 11:00:00", 0), (5, "2024-01-06", 0), mode="append")
    load = source_to_bronze(spark, spec, now="2024-01-05T12:00:00")
    assert load.window.lo == datetime(2024, 1, 4, tzinfo=UTC)
    # Row 3 comes again with the late row 4 of the same day.
    assert bronze_ids(spark, spec) == [2, 3, 3, 4]


def mark_file(spec, number):
    return Path(spec.marks_path, f"ingest={spec.ingest}", f"{number:012d}.json")


def test_a_load_whose_mark_was_lost_leaves_one_copy(spark, spec):
    """Also when it is repeated at a later time, when the source has more rows."""
    fill_source(spark, spec, (1, "2024-01-02", 0), (2, "2024-01-04 10:00:00", 0))
    first = source_to_bronze(spark, spec, now="2024-01-04T12:00:00")
    mark_file(spec, 1).unlink()
    fill_source(spark, spec, (3, "2024-01-04 11:00:00", 0), (4, "2024-01-05 11:00:00", 0), mode="append")
    again = source_to_bronze(spark, spec, now="2024-01-06T12:00:00")
    assert again.window == first.window and again.rows == 3
    assert bronze_ids(spark, spec) == [1, 2, 3]
    source_to_bronze(spark, spec, now="2024-01-06T12:00:00")
    assert bronze_ids(spark, spec) == [1, 2, 2, 3, 3, 4]


def test_a_repeated_load_without_rows_leaves_none(spark, spec):
    fill_source(spark, spec, (1, "2024-01-02", 0))
    source_to_bronze(spark, spec, now="2024-01-04T12:00:00")
    mark_file(spec, 1).unlink()
    fill_source(spark, spec)
    assert source_to_bronze(spark, spec, now="2024-01-06T12:00:00").rows == 0
    assert list(Path(spec.bronze_path).glob("_load=*")) == []


def test_a_repeated_backfill_replaces_itself(spark, spec):
    fill_source(spark, spec, (1, "2023-06-01", 0), (2, "2023-06-03", 0))
    for last in ("2023-06-02", "2023-06-02", "2023-06-04"):
        source_to_bronze(spark, spec, backfill=("2023-06-01", last))
    assert bronze_ids(spark, spec) == [1, 1, 2]


def test_loads_at_the_same_time(spark, spec, monkeypatch):
    """The second one to finish raises; both stored the load that the first one planned."""
    fill_source(spark, spec, (1, "2024-01-02", 0))
    put = flows.put_load

    def overtaken(*args):
        monkeypatch.setattr(flows, "put_load", put)
        source_to_bronze(spark, spec, now="2024-01-04T12:00:00")
        return put(*args)

    monkeypatch.setattr(flows, "put_load", overtaken)
    with pytest.raises(ConcurrentLoad):
        source_to_bronze(spark, spec, now="2024-01-05T12:00:00")
    assert bronze_ids(spark, spec) == [1] and read_mark(spark, spec.marks_path, "readings") == datetime(2024, 1, 5, tzinfo=UTC)


def test_backfill_leaves_the_mark_alone(spark, spec):
    fill_source(spark, spec, (1, "2023-06-01", 0), (2, "2023-06-02 00:00:00", 0), (3, "2023-06-02 00:00:01", 0))
    load = source_to_bronze(spark, spec, backfill=("2023-06-01", "2023-06-02"))
    assert load.rows == 2 and not load.window.scheduled
    assert source_to_bronze(spark, spec, now="2024-01-02").window.lo == datetime(2024, 1, 1, tzinfo=UTC)


def test_first_load_without_a_start_looks_back_three_days(spark, spec):
    spec = dataclasses.replace(spec, start_date=None)
    fill_source(spark, spec, (1, "2024-01-01", 0), (2, "2024-01-03", 0))
    assert source_to_bronze(spark, spec, now="2024-01-05").rows == 1


def test_table_without_delta_is_read_whole(spark, spec):
    spec = dataclasses.replace(spec, delta=None)
    fill_source(spark, spec, (1, "2020-01-01", 0), (2, None, 0))
    load = source_to_bronze(spark, spec)
    assert (load.rows, load.window) == (2, None)


def test_events(spark, spec):
    fill_source(spark, spec, (1, "2024-01-02 03:00:00", 1), (2, "2024-01-02 13:00:00", 2))
    source_to_bronze(spark, spec, now="2024-01-02T14:00:00")
    first = events_to_silver(spark, spec)
    assert first == 2 and first.partitions == {"2024-01-01", "2024-01-02"}
    source_to_bronze(spark, spec, now="2024-01-02T15:00:00")  # reads the day again
    assert bronze_to_silver(spark, spec, "event") == 0
    assert events_to_silver(spark, spec, index=True).partitions == frozenset()
    got = in_catalog(spark, spec.db, "readings").orderBy("id").selectExpr("id", "CAST(time AS STRING) AS t", "date")
    assert [tuple(r) for r in got.collect()] == [
        (1, "2024-01-01 22:00:00", "2024-01-01"),
        (2, "2024-01-02 08:00:00", "2024-01-02"),
    ]


def test_new_source_column(spark, spec):
    """Refused until accepted, then part of the table for good."""
    fill_source(spark, spec, (1, "2024-01-02 13:00:00", 1))
    source_to_bronze(spark, spec, now="2024-01-02T14:00:00")
    events_to_silver(spark, spec)
    wider = dataclasses.replace(spec, columns={**spec.columns, "other": "string"})
    fill_source(spark, wider, (2, "2024-01-02 13:00:00", 2), mode="append")
    source_to_bronze(spark, wider, now="2024-01-02T15:00:00")
    with pytest.raises(ValueError, match="other"):
        events_to_silver(spark, wider)
    events_to_silver(spark, wider, evolve=True)
    fill_source(spark, wider, (3, "2024-01-03 13:00:00", 2), mode="append")
    source_to_bronze(spark, wider, now="2024-01-03T15:00:00")
    events_to_silver(spark, wider)
    got = in_catalog(spark, spec.db, "readings").orderBy("id").select("id", "other").collect()
    assert [tuple(r) for r in got] == [(1, None), (2, "x"), (3, "x")]


def test_dimension(spark, spec):
    spec = dataclasses.replace(spec, delta=None)
    fill_source(spark, spec, (1, None, 1), (2, None, 2))
    source_to_bronze(spark, spec)
    fill_source(spark, spec, (1, None, 1), (2, None, 3))
    source_to_bronze(spark, spec)
    assert dimension_to_silver(spark, spec) == 3
    bronze_to_silver(spark, spec, "dimension")
    assert in_catalog(spark, spec.db, "readings").count() == 3


def test_a_failed_replacement_leaves_the_dimension(spark, spec):
    """Readers by name keep the version before, also those that had opened it."""
    spec = dataclasses.replace(spec, delta=None)
    fill_source(spark, spec, (1, None, 1))
    source_to_bronze(spark, spec)
    dimension_to_silver(spark, spec)
    opened = in_catalog(spark, spec.db, "readings")
    fill_source(spark, spec, (2, None, 2))
    source_to_bronze(spark, spec)
    broken = flows.read_dimension(spark, spec.bronze_path).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(flows, "read_dimension", lambda *_: broken)
        with pytest.raises(RuntimeError, match="Error writing dimension data to the Silver layer, error:"):
            dimension_to_silver(spark, spec)
    assert in_catalog(spark, spec.db, "readings").count() == 1
    assert dimension_to_silver(spark, spec) == 2
    assert opened.count() == 1 and in_catalog(spark, spec.db, "readings").count() == 2
    dimension_to_silver(spark, spec)
    assert len(list(Path(spec.silver_path).iterdir())) == 2


def test_partitions_are_registered_by_the_batch_that_fails_after_storing(spark, spec, monkeypatch):
    fill_source(spark, spec, (1, "2024-01-02 13:00:00", 1))
    source_to_bronze(spark, spec, now="2024-01-02T14:00:00")
    events_to_silver(spark, spec)
    fill_source(spark, spec, (2, "2024-01-03 13:00:00", 2), mode="append")
    source_to_bronze(spark, spec, now="2024-01-03T14:00:00")
    add = flows.add_partitions
    with monkeypatch.context() as m:
        m.setattr(flows, "add_partitions", lambda *_: 1 // 0)
        with pytest.raises(RuntimeError):
            events_to_silver(spark, spec)
    assert flows.add_partitions is add
    # The batch is delivered again; its row is stored already.
    again = events_to_silver(spark, spec)
    assert again == 0 and "2024-01-03" in again.partitions
    assert sorted(r["id"] for r in in_catalog(spark, spec.db, "readings").collect()) == [1, 2]


def test_other_kinds_are_refused(spark, spec):
    with pytest.raises(ValueError, match="'event' or 'dimension'"):
        bronze_to_silver(spark, spec, "fact")


def test_launcher(spark, spec, tmp_path):
    """The command line runs the same jobs from control documents."""
    for folder in ("ingestion", "connectors"):
        (tmp_path / "conf" / folder).mkdir(parents=True)
    conf = tmp_path / "conf"
    (conf / "environment.json").write_text(json.dumps({"root": str(tmp_path)}))
    (conf / "connectors" / "files.json").write_text(
        json.dumps({"format": "parquet", "options": spec.source_options})
    )
    source = {"db": spec.db, "table": spec.table, "columns": spec.columns, "delta_column": "time", "connector": "files.json"}
    (conf / "ingestion" / "readings.json").write_text(json.dumps({"source": source}))
    fill_source(spark, spec, (1, "2024-01-02 03:00:00", 1), (2, "2024-03-02 13:00:00", 2))
    main(["bronze", "--ingest", "readings", "--conf", str(conf), "--start", "2024-01-01", "--end", "2024-02-01"])
    main(["silver", "--ingest", "readings", "--conf", str(conf), "--scope", "partition", "--keep-copies", "--evolve", "--index"])
    assert [r["id"] for r in in_catalog(spark, spec.db, "readings").collect()] == [1]
    with pytest.raises(SystemExit):
        main(["bronze", "--ingest", "readings", "--conf", str(conf), "--start", "2024-01-01"])


def test_ingests_of_all_jobs_run_side_by_side(spark, monkeypatch):
    both = threading.Barrier(2, timeout=30)

    def load(*_, **__):
        both.wait()
        raise InterruptedError

    monkeypatch.setattr(queries.flows, "source_to_bronze", load)
    with pytest.raises(InterruptedError):
        queries.source_to_gold(spark, "/root/testdata/sf0.001")
