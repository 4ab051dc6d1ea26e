"""Row-wise shaping of events and the column functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierflow.functions import operating_state, or_unknown, or_zero
from tierflow.operators import batch_dates, between_dates, date_list, in_dates, localize_events, stringify_timestamps


def raw(spark, *times):
    rows = [(i, t, True, False) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "id bigint, time string, artificial boolean, recovered boolean")


def test_local_time_crosses_day_month_and_year(spark):
    df = localize_events(
        raw(spark, "2024-01-01 00:00:00", "2024-03-01 04:59:59.999", "2024-03-01 05:00:00", None)
    )
    got = [tuple(r) for r in df.orderBy("id").select(F.col("time").cast("string"), "date").collect()]
    assert got == [
        ("2023-12-31 19:00:00", "2023-12-31"),
        ("2024-02-29 23:59:59.999", "2024-02-29"),
        ("2024-03-01 00:00:00", "2024-03-01"),
        (None, None),
    ]


def test_localized_columns(spark):
    df = localize_events(raw(spark, "2024-01-01 00:00:00"))
    assert df.columns == ["id", "time", "date", "_ingested_at", "_filename"]
    assert dict(df.dtypes)["time"] == "timestamp" and dict(df.dtypes)["date"] == "string"
    # The two bookkeeping columns need not be there.
    assert localize_events(raw(spark, "2024-01-01 00:00:00").drop("artificial", "recovered")).count() == 1


def test_malformed_time_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        localize_events(raw(spark, "not a time")).collect()


def test_only_declared_timestamps_become_text(spark):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP '2024-01-02 03:04:05.600' AS a, TIMESTAMP '2024-01-01 00:00:00' AS b")
    out = stringify_timestamps(df, {"id": "integer", "a": "timestamp"})
    assert out.dtypes == [("id", "int"), ("a", "string"), ("b", "timestamp")]
    assert out.first()["a"] == "2024-01-02 03:04:05.6"
    assert stringify_timestamps(df, {"id": "integer"}) is df


def test_text_and_back_is_the_same_instant(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-06-30 23:59:59.123456' AS a")
    back = stringify_timestamps(df, {"a": "timestamp"}).select(F.col("a").cast("timestamp"))
    assert back.first() == df.first()


@pytest.mark.parametrize(
    ("text", "state"),
    [
        ("Grid-connected", "Grid-connected"),
        ("Grid-connected (metered)", "Grid-connected"),
        ("Standby: waiting", "Standby"),
        ("Shutdown 3", "Shutdown"),
        ("grid-connected", "Standby"),
        (" Shutdown", "Standby"),
        ("anything", "Standby"),
        ("", "Standby"),
        (None, "Standby"),
    ],
)
def test_states(spark, text, state):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(operating_state("s").alias("s")).first()["s"] == state


def test_fills(spark):
    df = spark.sql("SELECT CAST(NULL AS DOUBLE) AS x, 2.5D AS y")
    row = df.select(or_zero("x").alias("a"), or_zero("y").alias("b"), or_unknown("x").alias("c")).first()
    assert tuple(row) == (0.0, 2.5, -1.0)


def dated(spark, *dates):
    return spark.createDataFrame([(d,) for d in dates], "date string")


def test_date_selections(spark):
    df = dated(spark, "2024-01-01", "2024-01-02", "2024-01-02", "2024-01-03", None)
    assert between_dates(df, "2024-01-02", "2024-01-03").count() == 3
    assert batch_dates(df).count() == 4
    assert date_list(df) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert in_dates(df, ["2024-01-02", None]).count() == 2
    assert in_dates(df, []).count() == 0
    assert in_dates(df, dated(spark, "2024-01-02", "2024-01-02", None)).count() == 2
    assert in_dates(df, dated(spark)).count() == 0
