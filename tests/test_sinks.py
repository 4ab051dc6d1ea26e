"""Append, replace, partition overwrite and registration."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tierflow import store
from tierflow.sinks import (
    Rows,
    add_partitions,
    append,
    create_if_missing,
    current_version,
    overwrite_partitions,
    put_load,
    register,
    replace_distinct,
    replace_version,
)
from tierflow.sources import has_files, in_catalog, snapshot, table_exists

THREE = [(1, "2023-01-01"), (2, "2023-01-02"), (3, "2023-01-03")]


def three(spark):
    return spark.createDataFrame(THREE, "id bigint, time string")


def test_append(spark, tmp_path):
    path = str(tmp_path / "bronze")
    assert append(three(spark), path) == 3
    assert append(three(spark), path) == 3
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(RuntimeError, match="Error writing data to the Bronze layer, error:"):
        append(None, path)


def test_append_runs_the_plan_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = three(spark).mapInArrow(count, "id bigint, time string")
    assert append(df, str(tmp_path / "b")) == 3
    assert seen.value == 3


def test_replace_distinct(spark, tmp_path):
    path = str(tmp_path / "silver")
    assert replace_distinct(three(spark).union(three(spark)), path) == 3
    changed = three(spark).withColumn("extra", F.lit(True)).limit(2)
    assert replace_distinct(changed, path) == 2
    assert spark.read.parquet(path).columns == ["id", "time", "extra"]
    with pytest.raises(RuntimeError, match="Error writing dimension data to the Silver layer, error:"):
        replace_distinct(None, path)


def test_versions_of_a_row_are_kept(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [(1, "a"), (1, "b"), (1, "a"), (None, None), (None, None)]
    assert replace_distinct(spark.createDataFrame(rows, "id int, v string"), path) == 3


def test_latest_version_of_each_key(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [(1, "a", 1), (1, "b", 3), (1, "c", None), (2, "x", 1), (2, "y", 1), (None, "n", 1), (None, "m", 1)]
    df = spark.createDataFrame(rows, "id int, v string, t int")
    assert replace_distinct(df, path, key="id", latest_by="t") == 4
    got = sorted(map(tuple, spark.read.parquet(path).select("id", "v").collect()), key=repr)
    assert got == [(1, "b"), (2, "y"), (None, "m"), (None, "n")]


def dated(spark, *rows):
    return spark.createDataFrame(rows, "id int, v int, date string")


def test_only_partitions_in_the_frame_are_replaced(spark, tmp_path):
    path = str(tmp_path / "gold")
    a, b = "2024-01-01", "2024-01-02"
    assert overwrite_partitions(dated(spark, (1, 1, a), (2, 1, a), (3, 1, b)), path) == 3
    assert overwrite_partitions(dated(spark, (9, 2, b), (8, 2, None)), path) == 2
    got = sorted(map(tuple, snapshot(spark, path, dated(spark).schema).collect()))
    assert got == [(1, 1, a), (2, 1, a), (8, 2, None), (9, 2, b)]


def test_create_if_missing_leaves_data_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = dated(spark).schema
    create_if_missing(spark, path, schema)
    assert snapshot(spark, path, schema).count() == 0
    overwrite_partitions(dated(spark, (1, 1, "2024-01-01")), path)
    create_if_missing(spark, path, schema)
    assert snapshot(spark, path, schema).count() == 1


def test_a_large_partition_is_split_over_files(spark, tmp_path):
    """One date with nearly all rows does not end up in one task."""
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        df = spark.range(0, 400_000, 1, 8).select(
            F.xxhash64("id").alias("v"), F.when(F.col("id") < 1000, "2024-01-02").otherwise("2024-01-01").alias("date")
        )
        assert overwrite_partitions(df, path) == 400_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    files = {d: [f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")] for d in os.listdir(path) if "=" in d}
    assert len(files["date=2024-01-01"]) > 4
    assert len(files["date=2024-01-02"]) <= 2


@pytest.fixture
def database(spark):
    before = spark.catalog.currentDatabase()
    yield f"t_{uuid.uuid4().hex}"
    spark.catalog.setCurrentDatabase(before)


def test_register_finds_partitions(spark, tmp_path, database):
    path, schema = str(tmp_path / "t"), dated(spark).schema
    overwrite_partitions(dated(spark, (1, 1, "2024-01-01"), (2, 1, "2024-01-02")), path)
    register(spark, database, "t", path, schema, "date")
    assert spark.catalog.currentDatabase() == database
    assert table_exists(spark, f"{database}.t")
    assert in_catalog(spark, database, "t").count() == 2
    assert dict(in_catalog(spark, database, "t").dtypes)["date"] == "string"
    overwrite_partitions(dated(spark, (3, 1, "2024-01-03")), path)
    register(spark, database, "t", path, schema, "date")
    assert in_catalog(spark, database, "t").count() == 3
    plan = in_catalog(spark, database, "t").filter("date = '2024-01-03'")
    assert "PartitionFilters: [isnotnull(date" in plan._jdf.queryExecution().executedPlan().toString()


def test_registration_follows_the_schema(spark, tmp_path, database):
    path = str(tmp_path / "d")
    replace_distinct(three(spark), path)
    register(spark, database, "d", path, three(spark).schema, use=False)
    wider = three(spark).withColumn("extra", F.lit(1))
    replace_distinct(wider, path)
    register(spark, database, "d", path, wider.schema, use=False)
    assert in_catalog(spark, database, "d").columns == ["id", "time", "extra"]
    assert in_catalog(spark, database, "d").count() == 3


def test_without_adaptive_execution(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert overwrite_partitions(dated(spark, (1, 1, "2024-01-01"), (2, 1, "2024-01-02")), path) == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert snapshot(spark, path, dated(spark).schema).count() == 2


def listings(spark, action):
    """Statements that list a table's folder, of those that an action sends."""
    sent, sql = [], type(spark).sql
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(spark), "sql", lambda self, text, *a, **k: sent.append(text) or sql(self, text, *a, **k))
        action()
    return [s for s in sent if "RECOVER" in s or "MSCK" in s]


def test_later_registrations_do_not_list_the_table(spark, tmp_path, database):
    path, schema = str(tmp_path / "t"), dated(spark).schema

    def put(*rows):
        written = overwrite_partitions(dated(spark, *rows), path)
        return listings(spark, lambda: register(spark, database, "t", path, schema, "date", partitions=written.partitions))

    def ids():
        return sorted(r["id"] for r in in_catalog(spark, database, "t").collect())

    assert len(put((1, 1, "2024-01-01"))) == 1
    assert put((2, 1, "2024-01-02"), (3, 1, None), (4, 1, "it's a \\ day")) == [] and ids() == [1, 2, 3, 4]
    assert put((5, 1, "2024-01-02")) == [] and ids() == [1, 3, 4, 5]
    # Not told of: not seen, until all are looked for.
    overwrite_partitions(dated(spark, (6, 1, "2024-01-06")), path)
    register(spark, database, "t", path, schema, "date", partitions=[])
    assert ids() == [1, 3, 4, 5]
    register(spark, database, "t", path, schema, "date")
    assert ids() == [1, 3, 4, 5, 6]


def test_a_registration_that_was_not_finished_is_finished(spark, tmp_path, database):
    path, schema = str(tmp_path / "t"), dated(spark).schema
    overwrite_partitions(dated(spark, (1, 1, "2024-01-01")), path)
    spark.sql(f"CREATE SCHEMA `{database}`")
    spark.sql(f"CREATE TABLE `{database}`.t (id int, v int, date string) USING parquet PARTITIONED BY (date) LOCATION '{path}'")
    assert not add_partitions(spark, database, "t", "date", ["2024-01-01"])
    register(spark, database, "t", path, schema, "date", partitions=[])
    assert in_catalog(spark, database, "t").count() == 1


def test_columns_are_added_without_a_gap(spark, tmp_path, database):
    path, schema = str(tmp_path / "t"), dated(spark).schema
    overwrite_partitions(dated(spark, (1, 1, "2024-01-01")), path)
    register(spark, database, "t", path, schema, "date")
    wider = dated(spark, (2, 1, "2024-01-02")).select("id", "v", F.lit("x").alias("more"), "date")
    rows = overwrite_partitions(wider, path)
    sent = listings(spark, lambda: register(spark, database, "t", path, wider.schema, "date", partitions=rows.partitions))
    got = sorted(map(tuple, in_catalog(spark, database, "t").select("id", "more", "date").collect()))
    assert sent == [] and got == [(1, None, "2024-01-01"), (2, "x", "2024-01-02")]


def test_versions(spark, tmp_path):
    root, switched = str(tmp_path / "d"), []
    assert current_version(spark, root) is None
    for n in range(1, 5):
        assert replace_version(three(spark).unionAll(three(spark)).limit(2 * n if n < 3 else 6), root, switched.append) in (2, 3)
        assert current_version(spark, root) == switched[-1]
    assert store.versions(spark, root) == ["v000000003", "v000000004"]
    with pytest.raises(RuntimeError, match="Error writing dimension data"):
        replace_version(three(spark).withColumn("time", F.raise_error(F.lit("lost"))), root, switched.append)
    assert len(switched) == 4 and spark.read.parquet(current_version(spark, root)).count() == 3
    replace_version(three(spark), root, switched.append)
    assert store.versions(spark, root) == ["v000000004", "v000000005"]
    rows = [(1, "a", 1), (1, "b", 3), (2, "x", 1)]
    assert replace_version(spark.createDataFrame(rows, "id int, v string, t int"), root, switched.append, key="id", latest_by="t") == 2


def test_loads_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "b")
    append(three(spark), path)
    for load, n in (("a", 3), ("b", 2), ("a", 1)):
        assert put_load(three(spark).limit(n), path, load) == n
    assert spark.read.option("recursiveFileLookup", "true").parquet(path).count() == 6
    assert put_load(three(spark).limit(0), path, "b") == 0 and has_files(spark, path)
    assert spark.read.option("recursiveFileLookup", "true").parquet(path).count() == 4
    with pytest.raises(RuntimeError, match="Error writing data to the Bronze layer, error:"):
        put_load(None, path, "a")


def test_rows_and_their_partitions():
    a, b = Rows(3, ["x", None]), Rows(2, ["y", "x"])
    assert a == 3 and a.plus(b) == 5 and a.plus(b).partitions == {"x", "y", None}
