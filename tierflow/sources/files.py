"""Readers of tier tables and raw files."""

from __future__ import annotations

import itertools
import json
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierflow import errors, store
from tierflow.operators.events import localize_events

# Bound of one micro-batch of a first drain over a large raw folder.
MAX_BATCH_BYTES = str(256 * 1024**3)
# Files are known by name, not by age: one that arrives with an old timestamp
# counts as new all the same. Spark's default forgets them after a week; this is
# longer than any timestamp lies back.
MAX_FILE_AGE = "1000000d"
# When a raw file came, which orders copies of a key; not stored.
ARRIVED = "_arrived"
FILES = "path string, modified long"
# Folders of named loads in a raw table; not a column of the tables behind it.
LOAD = "_load"
# Raw tables have files in their folder and in those of their loads.
NESTED = {"recursiveFileLookup": "true"}
# Files whose footers are looked at in one job, and whose names the driver holds at once.
FOOTERS = 10_000
# Partitions opened by folder; each costs the driver one look-up.
MAX_FOLDER_LIST = 500
# Partition values whose folder name is the value itself.
PLAIN = re.compile(r"[A-Za-z0-9_.-]+")
# Fixed value: folder name of the partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists and holds anything but markers."""
    return any(not n.startswith(".") and (not n.startswith("_") or "=" in n or n == "_delta_log") for n in store.names(spark, path))


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the catalog knows a table."""
    return spark.catalog.tableExists(name)


def in_catalog(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A registered table."""
    return spark.table(f"`{database}`.`{name}`")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a given shape."""
    return spark.createDataFrame([], schema)


def snapshot(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    partition_by: str | None = None,
    values: Sequence[str | None] | None = None,
) -> DataFrame:
    """A stored table as of now, or its partitions with the given values.

    The schema is passed in: it keeps the partition column text, and an empty
    table reads as no rows. A short list of values opens only their folders,
    so that the cost does not grow with the table; longer lists and other
    formats list the table and prune it by a filter.
    """
    reader = spark.read.schema(schema).format(fmt)
    if values is None:
        return reader.load(path)
    if fmt == "delta" or len(values) > MAX_FOLDER_LIST or not all(v is None or PLAIN.fullmatch(v) for v in values):
        at = F.col(partition_by)
        wanted = at.isin([v for v in values if v is not None])
        return reader.load(path).filter(wanted | at.isNull() if None in values else wanted)
    folders = [f"{path}/{partition_by}={NO_VALUE if v is None else v}" for v in values]
    present = [f for f in folders if has_files(spark, f)]
    return reader.option("basePath", path).load(present) if present else empty(spark, schema)


def stored_schema(
    spark: SparkSession,
    path: str,
    partition_by: str | None = "date",
    fmt: str = "parquet",
    merge: bool = False,
) -> StructType | None:
    """Schema of a stored table, or None while it has no files: that of one
    file, or with `merge` the union over all."""
    if not has_files(spark, path):
        return None
    found = spark.read.option("mergeSchema", str(merge).lower()).format(fmt).load(path).schema
    return StructType(
        [StructField(f.name, StringType()) if f.name == partition_by else f for f in found.fields]
    )


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """All raw snapshots of a dimension table, with the columns of all of them.
    Snapshots whose types conflict are an error."""
    try:
        return spark.read.option("mergeSchema", "true").options(**NESTED).parquet(path)
    except Exception as e:
        raise RuntimeError(errors.LOAD_DIMENSION.format(cause=e)) from e


def event_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """New raw files as an unbounded table of silver events.

    Each file is delivered once per checkpoint. Micro-batches are bounded by
    `maxFilesPerTrigger` or `maxBytesPerTrigger`, and take files in the order of
    the column `_arrived`, which is not for storing.
    """
    options = dict(options or {})
    if not {"maxFilesPerTrigger", "maxBytesPerTrigger"} & options.keys():
        options["maxBytesPerTrigger"] = MAX_BATCH_BYTES
    options = {"maxFileAge": MAX_FILE_AGE, **NESTED, **options}
    try:
        raw = spark.readStream.schema(schema).format(fmt).options(**options).load(path)
        raw = raw.withColumn(ARRIVED, raw["_metadata.file_modification_time"])
        return localize_events(raw, filename=raw["_metadata.file_path"])
    except Exception as e:
        raise RuntimeError(errors.LOAD_EVENTS.format(cause=e)) from e


def remembered_schema(
    spark: SparkSession,
    path: str,
    memory: str,
    fmt: str = "parquet",
    evolve: bool = False,
) -> StructType:
    """Schema of a raw folder, inferred once and then kept (T5).

    Spark tasks merge the footers: of all files the first time, later of those
    not looked at before, whatever their timestamp. New columns raise rather
    than vanish; `evolve` accepts and remembers them. `memory` holds the schema
    and, as a table, the files looked at. The names of new files go from the listing to that
    table without passing through this process, which sees :data:`FOOTERS` of them at a
    time.
    """
    kept, checked = _recall(spark, memory)
    note = f"{memory}/_new-{uuid.uuid4().hex}"
    found = new = None
    try:
        if has_files(spark, path):
            # Only listed: the content is not selected.
            listed = spark.read.format("binaryFile").options(**NESTED).load(path)
            files = listed.select("path", F.unix_micros("modificationTime").alias("modified"))
            if checked is not None:
                files = files.join(checked, ["path", "modified"], "left_anti")
            files.write.parquet(note)
            new = spark.read.schema(FILES).parquet(note)
            found = _merged_schema(spark, new.select("path"), fmt)
        if kept is None and found is None:
            raise RuntimeError(errors.LOAD_EVENTS.format(cause=f"no files in {path}"))
        if kept is not None:
            added = [f for f in found.fields if f.name not in kept.names] if found else []
            if added and not evolve:
                raise ValueError(
                    f"columns {[f.name for f in added]} in {path} are not in the schema kept at {memory}"
                )
            found_new, found = found, StructType([*kept.fields, *added])
        else:
            found_new = found
        if found != kept:
            text = spark.createDataFrame([(found.json(),)], "value string")
            text.coalesce(1).write.mode("overwrite").text(f"{memory}/schema")
        if found_new is not None:
            new.write.mode("append").parquet(f"{memory}/files")
    finally:
        store.remove(spark, note)
    return found


def _merged_schema(spark: SparkSession, paths: DataFrame, fmt: str) -> StructType | None:
    """Union of the schemas of the listed files, slice by slice; None if there are none."""
    merged = None
    try:
        for some in itertools.batched((r["path"] for r in paths.toLocalIterator()), FOOTERS):
            found = spark.read.option("mergeSchema", "true").options(**NESTED).format(fmt).load(list(some)).schema
            merged = found if merged is None else _both(merged, found)
    except (AnalysisException, ValueError) as e:
        raise RuntimeError(errors.LOAD_EVENTS.format(cause=e)) from e
    return merged


def _both(a: StructType, b: StructType) -> StructType:
    """Fields of both schemas, which have to agree where they share a name."""
    fields = {f.name: f for f in a.fields}
    for f in b.fields:
        if f.name not in fields:
            fields[f.name] = f
        elif isinstance(f.dataType, StructType) and isinstance(fields[f.name].dataType, StructType):
            fields[f.name] = StructField(f.name, _both(fields[f.name].dataType, f.dataType))
        elif f.dataType != fields[f.name].dataType:
            raise ValueError(f"column {f.name} is {f.dataType.simpleString()} and {fields[f.name].dataType.simpleString()}")
    return StructType(list(fields.values()))


def _recall(spark: SparkSession, memory: str) -> tuple[StructType | None, DataFrame | None]:
    schema, files = f"{memory}/schema", f"{memory}/files"
    kept = None
    if has_files(spark, schema):
        kept = StructType.fromJson(json.loads(spark.read.text(schema, wholetext=True).first()["value"]))
    return kept, spark.read.schema(FILES).parquet(files) if has_files(spark, files) else None
