"""Relational statements and options, file readers, control documents."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql.types import StructType

from tierflow.operators import ingest_window
from tierflow.sources import (
    control_table,
    empty,
    event_stream,
    has_files,
    jdbc_options,
    load_spec,
    load_specs,
    query,
    read_dimension,
    read_table,
    remembered_schema,
    slices,
    snapshot,
    statement,
    stored_schema,
    table_exists,
)

COLUMNS = ["id", "time", "level", "station"]
TABLE = "readings_north_trial"
WINDOW = ingest_window(("2022-05-06", "2022-05-07"))


# --- relational --------------------------------------------------------------


def test_statement():
    root = "SELECT id, time, level, station FROM PUBLIC.readings_north_trial"
    assert statement(TABLE, COLUMNS) == root
    assert statement(TABLE, COLUMNS, "time", WINDOW) == (
        root + " WHERE time BETWEEN '2022-05-06 00:00:00+00:00' AND '2022-05-07 00:00:00+00:00'"
    )
    assert statement(TABLE, COLUMNS, None, WINDOW) == root


def test_bounded_reads_are_split():
    o = jdbc_options("jdbc", {"url": "jdbc:x"}, "SELECT 1", "time", WINDOW)
    assert o["dbtable"] == "(SELECT 1) src" and "query" not in o
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"]) == ("time", "2022-05-06 00:00:00", "2022-05-07 00:00:00")
    assert int(o["numPartitions"]) > 1 and int(o["fetchsize"]) > 0


def test_own_partition_options_win():
    own = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3", "fetchsize": "7"}
    o = jdbc_options("jdbc", own, "SELECT 1", "time", WINDOW)
    assert {k: o[k] for k in own} == own
    assert "partitionColumn" not in jdbc_options("jdbc", {}, "SELECT 1")


def test_postgresql_connector():
    options = {"host": "db", "port": "6543", "database": "d", "user": "u", "password": "p"}
    o = jdbc_options("postgresql", options, "SELECT 1")
    assert o["url"] == "jdbc:postgresql://db:6543/d" and o["driver"] == "org.postgresql.Driver"
    assert o["user"] == "u" and "host" not in o and options["host"] == "db"


def meets(condition, value, count):
    """Whether a value meets a condition of `slices`, with remainders as in SQL."""
    remainder = None if value is None else int(math.fmod(value, count))
    if " IN " in condition:
        return remainder is not None and remainder in eval(condition.split(" IN ")[1])
    return value is None or remainder == 0


@pytest.mark.parametrize("count", [1, 2, 7])
def test_every_row_is_in_one_slice(count):
    conditions = slices("k", count)
    assert len(conditions) == count
    for value in [None, *range(-20, 21)]:
        assert sum(meets(c, value, count) for c in conditions) == 1
    with pytest.raises(ValueError):
        slices("k", 0)


def test_slices_are_conditions_of_sql(spark):
    df = spark.createDataFrame([(v,) for v in [None, *range(-9, 10), 2**63 - 1, -(2**63)]], "k bigint")
    assert sum(df.filter(c).count() for c in slices("k", 4)) == df.count()
    assert slices("k", 2) == ["MOD(k, 2) = 0 OR k IS NULL", "MOD(k, 2) IN (1, -1)"]


def test_full_loads_are_dealt_out(spark, monkeypatch):
    asked = {}
    reader = type(spark.read)

    def jdbc(self, url, table, **options):
        asked.update(options, url=url, table=table)
        return spark.range(0).selectExpr("id", "id AS k")

    monkeypatch.setattr(reader, "jdbc", jdbc)
    options = {"url": "jdbc:x", "sliceColumn": "k", "numPartitions": "3", "user": "u"}
    assert read_table(spark, "jdbc", options, "t", ["id"]).columns == ["id"]
    assert asked["table"] == "(SELECT id, k FROM PUBLIC.t) src" and asked["predicates"] == slices("k", 3)
    assert asked["url"] == "jdbc:x" and asked["properties"] == {"fetchsize": "10000", "user": "u"}
    # A delta that is no time bounds the statement and does not split it.
    asked.clear()
    read_table(spark, "jdbc", options, "t", ["id", "k"], "id", WINDOW, split=False)
    assert asked["table"].startswith("(SELECT id, k FROM PUBLIC.t WHERE id BETWEEN")
    # A window that splits the read comes first.
    asked.clear()
    with pytest.raises(RuntimeError):
        read_table(spark, "jdbc", {**options, "url": "jdbc:none"}, "t", ["id", "time"], "time", WINDOW)
    assert not asked


def test_failure_names_the_statement(spark):
    with pytest.raises(RuntimeError, match="Error loading data with the SQL statement: SELECT 1, error:"):
        query(spark, "jdbc", {"url": "jdbc:none://x"}, "SELECT 1")
    with pytest.raises(RuntimeError, match="Error loading data with the SQL statement: SELECT id FROM PUBLIC.t, error:"):
        read_table(spark, "postgresql", {}, "t", ["id"])


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_file_source_is_bounded_and_pruned_in_the_scan(spark, tmp_path, kind):
    times = ["2022-05-05 00:00:00", "2022-05-06 00:00:00", "2022-05-07 00:00:00", "2022-05-08 00:00:00"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(times)], "id int, time string, other string")
    df.withColumn("time", df.time.cast(kind)).write.parquet(f"{tmp_path}/t")
    out = read_table(spark, "parquet", {"path": str(tmp_path)}, "t", ["id", "time"], "time", WINDOW)
    assert sorted(r["id"] for r in out.collect()) == [1, 2]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time," in plan and "LessThanOrEqual(time," in plan
    assert "other" not in plan
    assert read_table(spark, "parquet", {"path": str(tmp_path)}, "t", ["id"]).count() == 4


@pytest.mark.parametrize("fmt", ["orc", "json", "csv"])
def test_other_file_formats(spark, tmp_path, fmt):
    spark.range(5).selectExpr("id", "id * 2 AS v").write.option("header", True).format(fmt).save(f"{tmp_path}/t")
    options = {"path": str(tmp_path), "header": "true", "inferSchema": "true"}
    assert read_table(spark, fmt, options, "t", ["v"]).columns == ["v"]
    assert read_table(spark, fmt, options, "t", ["v"]).count() == 5


def test_missing_file_source(spark, tmp_path):
    with pytest.raises(RuntimeError, match="Error loading data from"):
        read_table(spark, "parquet", {"path": str(tmp_path)}, "none", ["id"])


# --- files -------------------------------------------------------------------


def test_dimension(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/d")
    assert read_dimension(spark, f"{tmp_path}/d").count() == 3
    with pytest.raises(RuntimeError, match="Error loading dimension data from the Bronze layer, error:"):
        read_dimension(spark, f"{tmp_path}/none")


def test_dimension_has_the_columns_of_all_snapshots(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(2).coalesce(1).write.parquet(path)
    spark.range(2, 3).selectExpr("id", "1 AS more").write.mode("append").parquet(path)
    assert read_dimension(spark, path).columns == ["id", "more"]
    spark.range(2).selectExpr("CAST(id AS string) AS id").write.mode("append").parquet(path)
    with pytest.raises(RuntimeError, match="Error loading dimension data from the Bronze layer, error:"):
        read_dimension(spark, path)


def test_stream_errors_are_named(spark, tmp_path):
    with pytest.raises(RuntimeError, match="Error loading and transforming event data from the Bronze layer, error:"):
        event_stream(spark, str(tmp_path / "b"), StructType.fromDDL("id bigint"))
    with pytest.raises(RuntimeError, match="Error loading and transforming event data from the Bronze layer, error:"):
        remembered_schema(spark, str(tmp_path / "none"), str(tmp_path / "m"))


def test_snapshot_of_an_empty_table(spark, tmp_path):
    schema = StructType.fromDDL("id bigint, date string")
    path = str(tmp_path / "t")
    empty(spark, schema).write.partitionBy("date").parquet(path)
    assert not has_files(spark, path) and not has_files(spark, str(tmp_path / "none"))
    assert stored_schema(spark, path) is None
    assert snapshot(spark, path, schema).count() == 0


def test_snapshot_of_some_partitions(spark, tmp_path):
    schema = StructType.fromDDL("id bigint, date string")
    path = str(tmp_path / "t")
    rows = [(1, "2024-01-01"), (2, "2024-01-02"), (3, None), (4, "2024-01-04")]
    spark.createDataFrame(rows, schema).write.partitionBy("date").parquet(path)

    def ids(values, **options):
        return sorted(r["id"] for r in snapshot(spark, path, schema, "parquet", "date", values).collect())

    assert ids(["2024-01-02", None, "2024-01-03"]) == [2, 3]
    assert ids(["2024-01-03"]) == [] and ids([]) == []
    assert ids(["2024-01-02", "a/b"]) == [2]  # odd values: by filter
    assert ids([f"x{i}" for i in range(600)] + ["2024-01-04", None]) == [3, 4]
    assert snapshot(spark, path, schema).schema["date"].dataType.typeName() == "string"
    assert dict(stored_schema(spark, path).jsonValue())["fields"][1]["type"] == "string"


def test_schema_is_remembered(spark, tmp_path):
    bronze, memory = str(tmp_path / "b"), str(tmp_path / "m")
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(bronze)
    first = remembered_schema(spark, bronze, memory)
    assert first.names == ["id", "x"]
    assert remembered_schema(spark, bronze, memory) == first
    spark.createDataFrame([(1, 2)], "id int, y int").write.mode("append").parquet(bronze)
    with pytest.raises(ValueError, match=r"columns \['y'\]"):
        remembered_schema(spark, bronze, memory)
    wider = remembered_schema(spark, bronze, memory, evolve=True)
    assert wider.names == ["id", "x", "y"] == remembered_schema(spark, bronze, memory).names


@pytest.mark.parametrize("footers", [10_000, 3])
def test_many_small_files(spark, tmp_path, monkeypatch, footers):
    """Their names reach the memory without being collected here."""
    monkeypatch.setattr("tierflow.sources.files.FOOTERS", footers)
    bronze, memory = str(tmp_path / "b"), str(tmp_path / "m")
    spark.range(40).selectExpr("id", "struct(id AS a) AS s").repartition(40).write.parquet(bronze)
    spark.range(3).selectExpr("id", "struct(id AS b) AS s", "1 AS more").write.parquet(f"{bronze}/_load=x")
    taken = []
    collect = type(spark.range(1)).collect
    with monkeypatch.context() as m:
        m.setattr(type(spark.range(1)), "collect", lambda self: taken.append(self.columns) or collect(self))
        found = remembered_schema(spark, bronze, memory)
    assert not any("path" in c for c in taken)
    assert found.names == ["id", "s", "more"] and sorted(found["s"].dataType.names) == ["a", "b"]
    looked_at = spark.read.parquet(f"{memory}/files")
    assert looked_at.count() == len(list((tmp_path / "b").rglob("*.parquet")))
    remembered_schema(spark, bronze, memory)
    assert spark.read.parquet(f"{memory}/files").count() == looked_at.count()
    assert not [n for n in (tmp_path / "m").iterdir() if n.name.startswith("_new")]


def test_slices_whose_types_conflict(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tierflow.sources.files.FOOTERS", 1)
    bronze = str(tmp_path / "b")
    spark.range(2).coalesce(1).write.parquet(bronze)
    spark.range(2).selectExpr("CAST(id AS string) AS id").coalesce(1).write.mode("append").parquet(bronze)
    with pytest.raises(RuntimeError, match="Error loading and transforming event data"):
        remembered_schema(spark, bronze, str(tmp_path / "m"))
    assert not (tmp_path / "m" / "files").exists()


def test_catalog_lookup(spark):
    assert not table_exists(spark, "no_such_table")


# --- control documents ---------------------------------------------------------

ENVIRONMENT = {
    "storage_account_name": "account",
    "storage_account_access_key": "secret",
    "silver_format": "delta",
    "gold_format": "delta",
}
INGEST = {
    "source": {
        "db": "plant",
        "table": TABLE,
        "columns": {"id": "integer", "time": "timestamp", "level": "float", "station": "integer"},
        "delta_column": "time",
        "calendar": {"start_date": "20230315"},
        "connector": "postgres.json",
    },
    "sink": {"source": {"format": "cloudFiles", "options": {"maxFilesPerTrigger": "5"}}},
}
CONNECTOR = {"format": "postgresql", "options": {"host": "h", "port": "6543", "password": "hidden"}}


@pytest.fixture
def documents(tmp_path):
    def write(environment=ENVIRONMENT, ingest=INGEST, connector=CONNECTOR):
        for folder in ("ingestion", "connectors"):
            (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / "environment.json").write_text(json.dumps(environment, indent=4))
        (tmp_path / "ingestion" / "readings.json").write_text(json.dumps(ingest, indent=4))
        (tmp_path / "connectors" / "postgres.json").write_text(json.dumps(connector, indent=4))
        return [f"{tmp_path}/{p}" for p in ("environment.json", "ingestion", "connectors")]

    return write


def test_spec(spark, documents):
    s = load_spec(spark, "readings", *documents())
    assert (s.ingest, s.db, s.table, s.delta, s.start_date, s.end_date) == (
        "readings", "plant", TABLE, "time", "20230315", None,
    )
    assert list(s.columns) == COLUMNS and s.columns["id"] == "integer"
    assert (s.silver_format, s.gold_format, s.bronze_format) == ("delta", "delta", "parquet")
    assert s.bronze_options == {"maxFilesPerTrigger": "5"}
    assert s.source_format == "postgresql" and s.source_options["port"] == "6543"
    assert s.bronze_path == f"abfss://bronze@account.dfs.core.windows.net/{TABLE}"
    assert s.silver_path == f"abfss://silver@account.dfs.core.windows.net/{TABLE}"
    assert s.gold_path("wide") == "abfss://gold@account.dfs.core.windows.net/wide"
    assert s.checkpoint_path == f"abfss://silver@account.dfs.core.windows.net/_checkpoints/{TABLE}"
    assert "hidden" not in repr(s)


@pytest.mark.parametrize("kind, expected", [("timestamp", True), ("DATE", True), ("integer", False), ("string", False)])
def test_only_dates_and_times_split_a_read(spark, documents, kind, expected):
    source = {**INGEST["source"], "columns": {"id": "integer", "time": kind}}
    assert load_spec(spark, "readings", *documents(ingest={"source": source})).delta_is_time is expected


def test_spec_with_own_root_and_few_fields(spark, documents):
    ingest = {"source": {"db": "d", "table": "node", "columns": {"id": "integer"}, "connector": "postgres.json"}}
    s = load_spec(spark, "readings", *documents({"root": "/data/"}, ingest, {"format": "parquet"}))
    assert (s.bronze_path, s.delta, s.start_date, s.source_options) == ("/data/bronze/node", None, None, {})
    assert (s.silver_format, s.bronze_format, s.bronze_options) == ("parquet", "parquet", {})


def test_missing_documents(spark, documents):
    env, ingests, connectors = documents()
    with pytest.raises(RuntimeError, match="Error loading environment medallion configuration file:"):
        load_spec(spark, "readings", env + "x", ingests, connectors)
    with pytest.raises(RuntimeError, match="Error loading ingestion configuration file:"):
        load_spec(spark, "other", env, ingests, connectors)
    with pytest.raises(RuntimeError, match="Error loading connector configuration file:"):
        load_spec(spark, "readings", env, ingests, connectors + "x")


def test_all_ingests_as_a_table(spark, documents, tmp_path):
    places = documents()
    other = {"source": {"db": "d", "table": "node", "columns": {"b": "int", "a": "int"}, "connector": "postgres.json"}}
    (tmp_path / "ingestion" / "nodes + 1%.json").write_text(json.dumps(other))
    rows = {r["ingest"]: r for r in control_table(spark, *places).collect()}
    assert rows.keys() == {"readings", "nodes + 1%"}
    specs = load_specs(spark, *places)
    for name in rows:
        assert specs[name] == load_spec(spark, name, *places) and list(specs[name].columns) == list(load_spec(spark, name, *places).columns)
        for place in ("bronze_path", "silver_path", "checkpoint_path", "schema_path", "index_path", "marks_path"):
            assert rows[name][place] == getattr(specs[name], place)


def test_ingests_with_faults(spark, documents, tmp_path):
    places = documents()
    lone = {"source": {"db": "d", "table": "t", "columns": {}, "connector": "none.json"}}
    (tmp_path / "ingestion" / "lone.json").write_text(json.dumps(lone))
    assert control_table(spark, *places).filter("source_format IS NULL").count() == 1
    with pytest.raises(RuntimeError, match="Error loading connector configuration file: ingest lone"):
        load_specs(spark, *places)
    (tmp_path / "ingestion" / "lone.json").write_text("{ no document")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        control_table(spark, *places).collect()
