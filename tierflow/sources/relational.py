"""Bounded reads of source tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow import errors
from tierflow.operators.bounds import Window, literal

# Rows per round trip; some drivers otherwise load a whole result into memory.
FETCH_SIZE = "10000"
DEFAULT_PARTITIONS = 32
# Connector option: whole-number column by which reads without a window are dealt out.
SLICE_COLUMN = "sliceColumn"


def statement(
    table: str,
    columns: Sequence[str],
    delta: str | None = None,
    window: Window | None = None,
    schema: str = "PUBLIC",
) -> str:
    """SQL text of the load: projected columns, bounded when both a delta
    column and a window are given (S2, S3)."""
    text = f"SELECT {', '.join(columns)} FROM {schema}.{table}"
    if delta and window:
        text += f" WHERE {delta} BETWEEN '{literal(window.lo)}' AND '{literal(window.hi)}'"
    return text


def jdbc_options(
    fmt: str,
    options: Mapping[str, str],
    sql: str,
    split_by: str | None = None,
    window: Window | None = None,
) -> dict[str, str]:
    """Reader options for a pushed-down statement.

    The statement goes in as a derived table, so projection and bounds run in
    the source database and the read can still be split: by `split_by` over
    the window, or as the connector's own partition options say. Rows outside
    the bounds are not lost, they only widen the first and last slice.
    """
    given = dict(options)
    if fmt == "postgresql":
        host, port, database = (given.pop(k, d) for k, d in (("host", "localhost"), ("port", "5432"), ("database", "")))
        given.setdefault("url", f"jdbc:postgresql://{host}:{port}/{database}")
        given.setdefault("driver", "org.postgresql.Driver")
    out = {"fetchsize": FETCH_SIZE, **given, "dbtable": f"({sql}) src"}
    if split_by and window and "partitionColumn" not in out:
        out |= {
            "partitionColumn": split_by,
            "lowerBound": window.lo.strftime("%Y-%m-%d %H:%M:%S"),
            "upperBound": window.hi.strftime("%Y-%m-%d %H:%M:%S"),
            "numPartitions": given.get("numPartitions", str(DEFAULT_PARTITIONS)),
        }
    return out


def slices(column: str, count: int) -> list[str]:
    """Conditions that deal the rows of a table out by a whole-number column.

    Each row meets one of them, whatever its value: remainders have the sign of their
    number, and rows without a value go with remainder 0. No bounds need to be known, and
    values that come in runs are spread evenly.
    """
    if count < 1:
        raise ValueError("a read has one slice at least")
    others = [f"MOD({column}, {count}) IN ({k}, -{k})" for k in range(1, count)]
    return [f"MOD({column}, {count}) = 0 OR {column} IS NULL", *others]


def query(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    sql: str,
    split_by: str | None = None,
    window: Window | None = None,
) -> DataFrame:
    """Result of a SQL text run in the source database.

    A read that no window splits is dealt out by `sliceColumn`, if the connector names one
    that the statement selects, over `numPartitions` connections.
    """
    given = dict(options)
    dealt = given.pop(SLICE_COLUMN, None)
    try:
        if dealt and not (split_by and window):
            o = jdbc_options(fmt, given, sql)
            count = int(o.pop("numPartitions", DEFAULT_PARTITIONS))
            return spark.read.jdbc(o.pop("url"), o.pop("dbtable"), predicates=slices(dealt, count), properties=o)
        options = given
        return spark.read.format("jdbc").options(**jdbc_options(fmt, options, sql, split_by, window)).load()
    except Exception as e:
        raise RuntimeError(errors.LOAD_SOURCE.format(sql=sql, cause=e)) from e


def read_table(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    table: str,
    columns: Sequence[str],
    delta: str | None = None,
    window: Window | None = None,
    split: bool = True,
) -> DataFrame:
    """A source table, projected and bounded at the source.

    Relational formats get a pushed-down statement; `split` says whether the read
    may be split over the window, which needs a `delta` of dates or times. Other reads are
    split by :func:`slices` if the connector names a column for it. File formats get a filter
    and a projection, which reach the scan as pushed filters and read schema.
    """
    if fmt in ("jdbc", "postgresql"):
        needed = (delta, options.get(SLICE_COLUMN))
        read = [*columns, *dict.fromkeys(c for c in needed if c and c not in columns)]
        sql = statement(table, read, delta, window)
        return query(spark, fmt, options, sql, delta if split else None, window).select(*columns)
    options = dict(options)
    path = f"{options.pop('path').rstrip('/')}/{table}"
    try:
        df = spark.read.format(fmt).options(**options).load(path)
        if delta and window:
            df = df.filter(bounded(df, delta, window))
        return df.select(*columns)
    except Exception as e:
        raise RuntimeError(f"Error loading data from {path}, error: {e}") from e


def bounded(df: DataFrame, delta: str, window: Window) -> Column:
    """`delta` BETWEEN the bounds (F1).

    The bounds are cast to the column's type, not the column to theirs: a cast
    column could not be pushed into the scan.
    """
    kind = df.schema[delta].dataType
    naive = kind.typeName() != "timestamp"
    lo, hi = (F.lit(literal(b)[:-6] if naive else literal(b)).cast(kind) for b in (window.lo, window.hi))
    return F.col(delta).between(lo, hi)
