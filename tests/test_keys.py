"""Insert-if-absent: literal rows for every rule, brute force for all plans."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tierflow.operators.keys import absent_rows, broadcast_size, first_per_key, in_key_range, key_profile
from tierflow.sinks import insert_if_absent
from tierflow.sinks.tables import _on_batch_dates
from tierflow.sources import snapshot

SCHEMA = "id bigint, time timestamp, v int, date string"
KEYS_SCHEMA = "id bigint"


def frame(spark, rows):
    """Rows given as (id, day, v); a day None means no time and no date."""
    text = [(i, day and f"2024-01-{day:02d} 00:00:00", v, day and f"2024-01-{day:02d}") for i, day, v in rows]
    return spark.createDataFrame(text, "id bigint, t string, v int, date string").select(
        "id", F.to_timestamp("t").alias("time"), "v", "date"
    )


def bag(df):
    return sorted(((r["id"], r["date"], r["v"]) for r in df.collect()), key=repr)


def expected(batch, stored_ids, dedupe):
    """The rule, row by row."""
    out, best = [], {}
    for row in batch:
        key = row[0]
        if key is None:
            out.append(row)
        elif key not in stored_ids:
            if not dedupe:
                out.append(row)
            elif key not in best or (row[1] or 99, row[2]) < (best[key][1] or 99, best[key][2]):
                best[key] = row
    rows = out + list(best.values())
    return sorted(((i, d and f"2024-01-{d:02d}", v) for i, d, v in rows), key=repr)


# Row counts, hot keys and byte bounds that lead to each join form.
FORMS = {
    "few keys": {},
    "many keys": {"broadcast_bytes": 0},
    "few repeated keys": {"broadcast_bytes": 100 * 80},
    "hot keys": {"broadcast_bytes": 0, "hot_rows": 20},
    "few stored keys": {"broadcast_bytes": 0, "known_size": 0},
    "few stored and few repeated keys": {"broadcast_bytes": 100 * 80, "known_size": 8000},
}


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("form", [*FORMS, "no profile"])
def test_forms_agree_with_brute_force(spark, form, dedupe):
    rng = random.Random(f"{form}{dedupe}")
    # A third of the rows share one key, a third have none.
    batch = [
        (rng.choice([None, 7, rng.randrange(400)]), rng.choice([None, *range(1, 6)]), rng.randrange(9))
        for _ in range(600)
    ]
    for stored in ([], [7] * 50 + [*range(0, 200, 3)], [1000, -5]):
        df = frame(spark, batch)
        known = spark.createDataFrame([(i,) for i in stored] + [(None,)], KEYS_SCHEMA)
        profile = None if form == "no profile" else key_profile(df)
        result = absent_rows(df, known, profile=profile, dedupe=dedupe, **FORMS.get(form, {}))
        assert result.columns == df.columns
        assert bag(result) == expected(batch, set(stored), dedupe)


def test_profile(spark):
    p = key_profile(frame(spark, [(1, 1, 0), (1, 2, 0), (5, 1, 0), (None, 1, 0)]))
    assert (p.rows, p.null_rows, p.keys, p.repeated, p.lo, p.hi, p.hottest, p.width) == (4, 1, 2, 1, 1, 5, 2, 16)


def test_size_of_stored_keys(spark):
    p = key_profile(frame(spark, [(2, 1, 0), (5, 1, 0)]))
    known = spark.createDataFrame([(i,) for i in (1, 2, 3, 5, 6, None)], KEYS_SCHEMA)
    assert broadcast_size(in_key_range(known, "id", p), "id") == 3 * 80
    assert broadcast_size(spark.createDataFrame([("ab",), ("abcd",)], "id string"), "id") == 2 * 68
    assert broadcast_size(known.limit(0), "id") == 0


def test_few_stored_keys_leave_a_large_batch_in_place(spark, tmp_path):
    """As in a back-fill: the batch is large, the stored keys lie elsewhere."""
    path = str(tmp_path / "b")
    frame(spark, [(i, 2, 1) for i in range(100)]).write.parquet(path)
    batch = spark.read.parquet(path)
    known = spark.createDataFrame([(5,), (1000,)], KEYS_SCHEMA)
    out = absent_rows(batch, known, profile=key_profile(batch), broadcast_bytes=160, known_size=80)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert out.count() == 99


def test_profile_of_nothing(spark):
    p = key_profile(frame(spark, []))
    assert (p.rows, p.null_rows, p.keys, p.hottest) == (0, 0, 0, 0)


def test_text_keys(spark):
    df = spark.createDataFrame([("a", 1), ("bb", 2), (None, 3)], "id string, v int")
    known = spark.createDataFrame([("bb",)], "id string")
    assert key_profile(df).width == 2
    out = absent_rows(df, known, profile=key_profile(df), order_by=["v"])
    assert sorted(r["v"] for r in out.collect()) == [1, 3]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = frame(spark, [(7, 1, v) for v in range(100)])
    plan = first_per_key(df)._jdf.queryExecution().optimizedPlan().toString()
    physical = first_per_key(df)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "Partial" in physical and "Final" in physical


def test_repeated_stored_keys_are_reduced_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.range(1000).selectExpr("id % 3 AS id").write.parquet(path)
    known, batch = spark.read.parquet(path), frame(spark, [(i, 1, 0) for i in range(50)])
    out = absent_rows(batch, known, profile=key_profile(batch), broadcast_bytes=0, dedupe=False)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [id" in plan[plan.index("LeftAnti") :]
    assert sorted(r["id"] for r in out.collect()) == list(range(3, 50))


def test_only_the_range_of_repeated_keys_is_read_again(spark, tmp_path):
    path = str(tmp_path / "b")
    frame(spark, [(i, 1, 0) for i in range(50)] + [(7, 1, 1), (9, 1, 1)]).write.parquet(path)
    batch = spark.read.parquet(path)
    out = absent_rows(batch, spark.range(0), profile=key_profile(batch))
    assert "GreaterThanOrEqual(id,7), LessThanOrEqual(id,9)" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 50


def test_a_known_time_beats_an_unknown_one(spark):
    assert bag(first_per_key(frame(spark, [(1, None, 1), (1, 3, 2)]))) == [(1, "2024-01-03", 2)]


def test_few_keys_move_neither_side(spark, tmp_path):
    stored = str(tmp_path / "s")
    frame(spark, [(i, 1, 0) for i in range(50)]).write.parquet(stored)
    batch = str(tmp_path / "b")
    frame(spark, [(i, 2, 1) for i in range(40, 60)]).write.parquet(batch)
    batch = spark.read.parquet(batch)
    out = absent_rows(batch, spark.read.parquet(stored), profile=key_profile(batch))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert "GreaterThanOrEqual(id,40), LessThanOrEqual(id,59)" in plan
    assert bag(out) == [(i, "2024-01-02", 1) for i in range(50, 60)]


# --- the sink --------------------------------------------------------------


def insert(spark, path, rows, **options):
    return insert_if_absent(frame(spark, rows), path, **options)


def stored(spark, path):
    return bag(snapshot(spark, path, frame(spark, []).schema))


def test_first_write_wins_and_null_keys_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    assert insert(spark, path, [(1, 1, 10), (2, 1, 20), (None, 1, 0)]) == 3
    assert insert(spark, path, [(2, 1, 99), (3, 1, 30), (None, 1, 0)]) == 2
    assert stored(spark, path) == sorted(
        [(1, "2024-01-01", 10), (2, "2024-01-01", 20), (3, "2024-01-01", 30)] + [(None, "2024-01-01", 0)] * 2, key=repr
    )


def test_copies_within_a_batch(spark, tmp_path):
    rows = [(1, 3, 3), (1, 2, 2), (1, 3, 1)]
    once, raw = str(tmp_path / "once"), str(tmp_path / "raw")
    insert(spark, once, rows)
    insert(spark, raw, rows, dedupe_batch=False)
    assert stored(spark, once) == [(1, "2024-01-02", 2)]
    assert len(stored(spark, raw)) == 3


def test_scope(spark, tmp_path):
    """The same key on another date: found table-wide, not in the partition."""
    wide, narrow = str(tmp_path / "wide"), str(tmp_path / "narrow")
    for path, scope in ((wide, "table"), (narrow, "partition")):
        insert(spark, path, [(1, 1, 1)], scope=scope)
        insert(spark, path, [(1, 2, 2), (1, None, 3), (4, None, 4)], scope=scope, dedupe_batch=False)
        insert(spark, path, [(4, None, 5)], scope=scope)
    assert stored(spark, wide) == sorted([(1, "2024-01-01", 1), (4, None, 4)], key=repr)
    assert len(stored(spark, narrow)) == 4


def test_partition_scope_reads_only_the_dates_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    insert(spark, path, [(i, 1 + i % 5, 0) for i in range(20)])
    batch = frame(spark, [(50, 2, 0)])
    files = _on_batch_dates(spark, path, batch, ["id"], "date", "parquet").inputFiles()
    assert files and all("date=2024-01-02" in f for f in files)


def test_empty_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    assert insert(spark, path, []) == 0
    assert stored(spark, path) == []


def test_only_keyless_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert insert(spark, path, [(None, 1, 1), (None, None, 2)]) == 2
    assert insert(spark, path, [(None, 1, 1)], dedupe_batch=False) == 1


def test_batch_that_does_not_come_out_the_same_again(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = frame(spark, [(i, 1, i) for i in range(100)]).withColumn("id", (F.rand() * 10).cast("bigint"))
    insert_if_absent(batch, path, cache=True)
    ids = [r[0] for r in stored(spark, path)]
    assert len(ids) == len(set(ids))


def test_schema_drift_is_loud(spark, tmp_path):
    path = str(tmp_path / "t")
    insert(spark, path, [(1, 1, 1)])
    wider = frame(spark, [(2, 1, 1)]).withColumn("extra", F.lit(1))
    with pytest.raises(ValueError, match="unknown column extra"):
        insert_if_absent(wider, path)
    with pytest.raises(ValueError, match="missing column v"):
        insert_if_absent(frame(spark, [(2, 1, 1)]).drop("v"), path)
    with pytest.raises(ValueError, match="v is string, stored as int"):
        insert_if_absent(frame(spark, [(2, 1, 1)]).withColumn("v", F.lit("x")), path)
    insert_if_absent(wider, path, merge_schema=True)
    assert len(stored(spark, path)) == 2


def test_lineage_makes_a_repeated_batch_harmless(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = frame(spark, [(1, 1, 1), (None, 1, 2), (None, None, 3)]).withColumn("_filename", F.lit("f1"))
    other = batch.withColumn("_filename", F.lit("f2"))
    assert insert_if_absent(batch, path, lineage="_filename") == 3
    assert insert_if_absent(batch, path, lineage="_filename") == 0
    assert insert_if_absent(other, path, lineage="_filename") == 2


@pytest.mark.parametrize("max_files", [100_000, 1])
def test_replay_completes_what_is_stored_in_part(spark, tmp_path, monkeypatch, max_files):
    """One of three keyless rows was visible; equal rows count."""
    monkeypatch.setattr("tierflow.sinks.tables.MAX_FILE_LIST", max_files)
    path = str(tmp_path / "t")
    rows = [(None, 1, 2), (None, 1, 2), (None, None, 3), (4, 1, 4)]
    batch = frame(spark, rows).withColumn("_filename", F.lit("f1")).withColumn("_ingested_at", F.current_timestamp())
    batch = batch.unionByName(batch.filter("v = 3").withColumn("_filename", F.lit("f2")))
    insert_if_absent(batch.filter("v = 2").limit(1), path, lineage="_filename")
    assert insert_if_absent(batch, path, lineage="_filename") == 4
    assert insert_if_absent(batch, path, lineage="_filename") == 0
    assert snapshot(spark, path, batch.schema).filter("_ingested_at IS NULL").count() == 0


def test_many_dates_are_looked_up_by_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tierflow.operators.dates.MAX_DATE_LIST", 1)
    path = str(tmp_path / "t")
    rows = [(1, 1, 1), (2, 2, 2), (3, None, 3)]
    assert insert(spark, path, rows, scope="partition") == 3
    assert insert(spark, path, [*rows, (4, 4, 4)], scope="partition") == 1


def test_packing_into_batches_does_not_matter(spark, tmp_path):
    """With copies removed, the table holds one row per key however the rows
    are cut into batches in time order, and a replay changes nothing."""
    rng = random.Random(3)
    rows = sorted(((rng.randrange(30), rng.randrange(1, 20), rng.randrange(5)) for _ in range(120)), key=lambda r: (r[1], r[2]))
    results = []
    for n, size in enumerate((120, 50, 17)):
        path = str(tmp_path / f"t{n}")
        batches = list(itertools.batched(rows, size))
        for batch in (*batches, batches[0]):
            insert(spark, path, batch)
        results.append(stored(spark, path))
    assert results[0] == results[1] == results[2] == expected(rows, set(), True)
