"""Small helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tierflow.session import shared_dir

# Tables up to this many estimated bytes may be broadcast; larger ones are shuffled.
BROADCAST_BYTES = 64 << 20


# Bytes of text that a Python worker gets at once.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def bounded(spark: SparkSession) -> SparkSession:
    """Bound the batches that go to Python; a session's own choice stands."""
    if ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text modulo `folds`; -1 for rows without a key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(-1))


def uniform(*cols: str | Column) -> Column:
    """A repeatable number in [0, 1) for each row."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def fresh(taken: Sequence[str], name: str) -> str:
    """`name`, with underscores until no column has it (names compare without case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def with_columns(
    df: DataFrame, fields: Sequence[T.StructField], compute: Callable[[pa.RecordBatch], Sequence[pa.Array]]
) -> DataFrame:
    """All columns of `df` and the new ones that `compute` makes of each Arrow batch."""
    bounded(df.sparkSession)
    schema = T.StructType([*df.schema.fields, *fields])
    added = to_arrow_schema(T.StructType(list(fields)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [a.cast(f.type) for a, f in zip(compute(batch), added, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], schema=pa.schema([*batch.schema, *added])
            )

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def stored(df: DataFrame, label: str, made: list[str] | None = None) -> DataFrame:
    """`df` written to the shared folder and read again: lineage is cut, and lost
    executors cost a read only. Its path is added to `made`, for when it has been used."""
    spark = bounded(df.sparkSession)
    path = shared_dir(spark, label)
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def small_side(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """`df` marked for broadcast if its counted rows are few enough to be one."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if fits_broadcast(rows, row_bytes) else df
