"""Writers. Each runs its plan once and returns the
number of rows it wrote, with the partitions they went to, observed during the write."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierflow import errors, store
from tierflow.operators.bounds import Window
from tierflow.operators.dates import date_list
from tierflow.operators.keys import BROADCAST_BYTES, absent_rows, broadcast_size, in_key_range, key_profile
from tierflow.sinks.index import KeyIndex
from tierflow.sources.files import LOAD, NO_VALUE, empty, has_files, snapshot, stored_schema

# Versions of a replaced table that stay: the current one and the one before.
VERSIONS = 2
# Table property: all partitions of the folder were looked for once.
RECOVERED = "tierflow.recovered"
# Partitions per catalog statement.
ADD_AT_ONCE = 500
# File paths are broadcast only up to this many.
MAX_FILE_LIST = 100_000
# Fixed value: the column that tells when a row was inserted.
INGESTED_AT = "_ingested_at"


class Rows(int):
    """A number of rows, and the partitions they were written to (None is the one without
    a value)."""

    partitions: frozenset[str | None]

    def __new__(cls, rows: int, partitions: Iterable[str | None] = ()) -> Rows:
        out = super().__new__(cls, rows)
        out.partitions = frozenset(partitions)
        return out

    def plus(self, other: Rows) -> Rows:
        """Both together."""
        return Rows(self + other, self.partitions | other.partitions)


def append(df: DataFrame, path: str) -> Rows:
    """Add a frame to a raw table (K1)."""
    try:
        return _counted(df, lambda w: w.mode("append").parquet(path))
    except Exception as e:
        raise RuntimeError(errors.WRITE_BRONZE.format(cause=e)) from e


def load_name(window: Window) -> str:
    """Folder of the load of a window: the same for the same bounds."""
    return "_".join(f"{t:%Y%m%dT%H%M%S}{t.microsecond:06d}" for t in (window.lo, window.hi))


def put_load(df: DataFrame, path: str, load: str) -> Rows:
    """Make a frame the whole of a named load of a raw table (K1, Q26).

    A load that is put again replaces what it had stored, other loads stay: the folder
    of the load is swapped when the job commits. A load without rows leaves no folder.
    """
    try:
        rows = _counted(
            df.withColumn(LOAD, F.lit(load)),
            lambda w: w.partitionBy(LOAD).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path),
        )
    except Exception as e:
        raise RuntimeError(errors.WRITE_BRONZE.format(cause=e)) from e
    if not rows:
        store.remove(df.sparkSession, f"{path}/{LOAD}={load}")
    return rows


def replace_distinct(
    df: DataFrame, path: str, fmt: str = "parquet", key: str | None = None, latest_by: str | None = None
) -> Rows:
    """Replace a dimension table, schema included, by the distinct rows (K4, A5).

    The table is gone while the new one is written; :func:`replace_version` keeps it.

    With `key` and `latest_by` only the row with the greatest `latest_by` stays
    of each key (Q9), ties to the greatest remaining columns; rows without a key
    all stay.
    """
    try:
        return _counted(
            latest_per_key(df, key, latest_by) if key else df.distinct(),
            lambda w: w.mode("overwrite").format(fmt).option("overwriteSchema", "true").save(path),
        )
    except Exception as e:
        raise RuntimeError(errors.WRITE_DIMENSION.format(cause=e)) from e


def replace_version(
    df: DataFrame,
    root: str,
    switch: Callable[[str], None],
    fmt: str = "parquet",
    key: str | None = None,
    latest_by: str | None = None,
) -> Rows:
    """The rows of :func:`replace_distinct` as a new version beside the stored one (K4, A5).

    Readers see the version before until `switch` is called with the folder of the
    complete new one, as :func:`register` does for readers by name; readers by path ask
    :func:`current_version`. The version before stays for those who opened it; older ones,
    and what failed runs left, go. One writer per table.
    """
    spark = df.sparkSession
    names = store.versions(spark, root)
    path = f"{root}/{store.next_version(spark, root)}"
    try:
        rows = _counted(latest_per_key(df, key, latest_by) if key else df.distinct(), lambda w: w.format(fmt).save(path))
    except Exception as e:
        raise RuntimeError(errors.WRITE_DIMENSION.format(cause=e)) from e
    switch(path)
    stay = [n for n in names if _complete(spark, f"{root}/{n}")][1 - VERSIONS :]
    for name in names:
        if name not in stay:
            store.remove(spark, f"{root}/{name}")
    return rows


def current_version(spark: SparkSession, root: str) -> str | None:
    """Folder of the latest complete version of a replaced table."""
    for name in reversed(store.versions(spark, root)):
        if _complete(spark, f"{root}/{name}"):
            return f"{root}/{name}"
    return None


def _complete(spark: SparkSession, version: str) -> bool:
    return store.exists(spark, f"{version}/_SUCCESS")


def latest_per_key(df: DataFrame, key: str, latest_by: str) -> DataFrame:
    """The latest distinct row of every key, and all distinct rows without one."""
    rest = [c for c in df.columns if c not in (key, latest_by)]
    keyed = df.filter(F.col(key).isNotNull())
    best = keyed.groupBy(key).agg(F.max(F.struct(latest_by, *rest)).alias("_best")).select(key, "_best.*")
    return best.select(df.columns).unionByName(df.filter(F.col(key).isNull()).distinct())


def overwrite_partitions(df: DataFrame, path: str, partition_by: str = "date", fmt: str = "parquet") -> Rows:
    """Replace only the partitions that occur in the frame (K5)."""
    return _counted(
        _by_partition(df, partition_by),
        lambda w: w.format(fmt)
        .partitionBy(partition_by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .save(path),
        partition_by,
    )


def create_if_missing(
    spark: SparkSession, path: str, schema: StructType, partition_by: str = "date", fmt: str = "parquet"
) -> None:
    """An empty partitioned table, unless something is there already (K2)."""
    empty(spark, schema).write.format(fmt).partitionBy(partition_by).mode("ignore").save(path)


def check_schema(stored: StructType | None, incoming: StructType, merge_schema: bool = False) -> None:
    """Raise when a batch does not fit the table it goes to; `merge_schema`
    allows columns the table does not have yet."""
    if stored is None:
        return
    old = {f.name: f.dataType for f in stored.fields}
    new = {f.name: f.dataType for f in incoming.fields}
    problems = [f"missing column {n}" for n in old if n not in new]
    problems += [f"{n} is {new[n].simpleString()}, stored as {old[n].simpleString()}" for n in old if n in new and old[n] != new[n]]
    if not merge_schema:
        problems += [f"unknown column {n}" for n in new if n not in old]
    if problems:
        raise ValueError("batch does not fit the stored table: " + "; ".join(problems))


def check_stored(
    spark: SparkSession,
    path: str,
    incoming: StructType,
    partition_by: str = "date",
    fmt: str = "parquet",
    merge_schema: bool = False,
) -> None:
    """:func:`check_schema` against a stored table. One file speaks for the
    table; only when the batch does not fit that one are all looked at."""
    try:
        check_schema(stored_schema(spark, path, partition_by, fmt), incoming, merge_schema)
    except ValueError:
        check_schema(stored_schema(spark, path, partition_by, fmt, merge=True), incoming, merge_schema)


def insert_if_absent(
    batch: DataFrame,
    path: str,
    key: str = "id",
    scope: str = "table",
    dedupe_batch: bool = True,
    lineage: str | None = None,
    partition_by: str = "date",
    fmt: str = "parquet",
    merge_schema: bool = False,
    schema_checked: bool = False,
    cache: bool = False,
    order_by: Sequence[str] = ("time", "_filename"),
    transient: Sequence[str] = (),
    index: str | None = None,
) -> Rows:
    """Append the rows whose key the table does not hold (K3, J1, J2; Q1-Q4).

    `scope="table"` looks the keys up in the whole table; `"partition"` only in
    the batch's dates, which is enough when the date of a key never changes and
    prunes the lookup to those partitions. Only the key column is read.

    With `index`, the folder of a :class:`~tierflow.sinks.index.KeyIndex`, the whole
    table is looked up in bitmaps of whole-number keys instead of in its files; the same
    rows are inserted. A batch whose keys lie too far apart for that takes the files.

    Rows without a key are always inserted. With `lineage`, the name of a
    source-file column, those of a file that is stored already are compared with
    the stored ones as a bag, so that a micro-batch delivered twice is stored once
    and one of which a part is stored is completed. Such tables cannot have map
    columns.

    Of copies inside the batch the first by `order_by` is taken. `transient`
    columns serve that order and are not stored.

    The batch is read a few times, first its keys, then its rows. Reading
    files again is cheaper than storing a wide batch; set `cache` for batches
    that are costly to compute or would not come out the same again.

    Returned are the rows inserted, with the partitions of the whole batch: those of rows that
    an attempt before had stored count as well.

    One writer per table: the lookup and the append are two steps.
    """
    spark = batch.sparkSession
    schema = batch.drop(*transient).schema
    create_if_missing(spark, path, schema, partition_by, fmt)
    if not schema_checked:
        check_stored(spark, path, schema, partition_by, fmt, merge_schema)

    if cache:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seen = Observation()
        profile = key_profile(batch.observe(seen, *_partition_values(partition_by)), key)
        if not profile.rows:
            return Rows(0)
        rows = batch
        if lineage and profile.null_rows:
            stored = _on_batch_dates(spark, path, batch, schema.names, partition_by, fmt)
            rows = _without_stored_keyless(batch, stored, key, lineage)
        known = None
        if scope == "partition":
            known = _on_batch_dates(spark, path, batch, [key], partition_by, fmt)
        elif index:
            known = KeyIndex(index, path, key, partition_by, fmt).lookup(batch, schema, profile)
        if known is None:
            known = snapshot(spark, path, _fields(batch, [key, partition_by]), fmt)
        size = None
        if not profile.fits(profile.keys, BROADCAST_BYTES):
            size = broadcast_size(in_key_range(known, key, profile), key)
        fresh = absent_rows(rows, known, key, profile, dedupe_batch, order_by, size).drop(*transient)
        rows = _counted(
            _by_partition(fresh, partition_by),
            lambda w: w.format(fmt).partitionBy(partition_by).mode("append").save(path),
        )
        return Rows(rows, _values(seen))
    finally:
        if cache:
            batch.unpersist()


def register(
    spark: SparkSession,
    database: str,
    name: str,
    path: str,
    schema: StructType,
    partition_by: str | None = None,
    fmt: str = "parquet",
    use: bool = True,
    partitions: Iterable[str | None] | None = None,
) -> None:
    """Create schema and external table if missing, then pick up partitions (K7).

    `partitions` are those written since the last registration, as the sinks return them:
    a table known already is told of them alone and its folder is not listed. Without
    them, or when a table is new, all are looked for.

    A table that lies elsewhere is pointed at `path`. Columns added at the end are added to a
    registration; one whose columns differ otherwise is renewed. The data stays.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`")
    if use:
        spark.sql(f"USE `{database}`")
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    target = f"`{database}`.`{name}`"
    layout = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    location = path.replace("'", "\\'")
    if fmt == "delta":
        # The transaction log is the schema.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {target} USING delta LOCATION '{location}'")
        return
    known = spark.catalog.tableExists(target)
    if known and not _same_columns(spark.table(target).schema, schema):
        if spark.catalog.getTable(target).tableType != "EXTERNAL":
            raise ValueError(f"{target} is a managed table with other columns")
        held = [f for f in spark.table(target).schema if f.name != partition_by]
        wanted = [f for f in schema.fields if f.name != partition_by]
        if _same_columns(StructType(held), StructType(wanted[: len(held)])):
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted[len(held) :])
            spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({added})")
        else:
            spark.sql(f"DROP TABLE {target}")
            known = False
    if not known:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {target} ({', '.join(columns)}) USING {fmt} {layout} LOCATION '{location}'")
    elif not _same_place(spark, target, path):
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{location}'")
    if partition_by and not (known and partitions is not None and add_partitions(spark, database, name, partition_by, partitions)):
        spark.sql(f"ALTER TABLE {target} RECOVER PARTITIONS")
        spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('{RECOVERED}' = 'true')")
    spark.catalog.refreshTable(target)


def add_partitions(spark: SparkSession, database: str, name: str, partition_by: str, values: Iterable[str | None]) -> bool:
    """Tell the catalog of some partitions of a table (K7); False, and nothing done, if the table
    was never registered to the end."""
    target = f"`{database}`.`{name}`"
    if not spark.catalog.tableExists(target):
        return False
    if spark.sql(f"SHOW TBLPROPERTIES {target}").filter(f"key = '{RECOVERED}' AND value = 'true'").isEmpty():
        return False
    texts = sorted(NO_VALUE if v is None else v for v in values)
    for some in itertools.batched(texts, ADD_AT_ONCE):
        quoted = ("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in some)
        spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS " + " ".join(f"PARTITION (`{partition_by}` = {v})" for v in quoted))
    return True


def _same_place(spark: SparkSession, target: str, path: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").filter("col_name = 'Location'").collect()
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(rows) and files.makeQualified(place(path)).toString() == files.makeQualified(place(rows[0]["data_type"])).toString()


def _counted(df: DataFrame, save: Callable[[DataFrameWriter], None], partition_by: str | None = None) -> Rows:
    """Save a frame and return its row count, and the values of a partition column, from the
    same execution (A7)."""
    seen = Observation()
    measures = _partition_values(partition_by) if partition_by else []
    save(df.observe(seen, F.count(F.lit(1)).alias("rows"), *measures).write)
    return Rows(seen.get["rows"], _values(seen) if partition_by else ())


def _partition_values(partition_by: str) -> list[Column]:
    at = F.col(partition_by)
    return [F.collect_set(at.cast("string")).alias("values"), F.count(F.when(at.isNull(), 1)).alias("without")]


def _values(seen: Observation) -> list[str | None]:
    return [*seen.get["values"], *([None] if seen.get["without"] else [])]


def _same_columns(a: StructType, b: StructType) -> bool:
    return {f.name: f.dataType for f in a} == {f.name: f.dataType for f in b}


def _by_partition(df: DataFrame, partition_by: str) -> DataFrame:
    """Rows gathered by partition value, in files of about the advisory size.

    The adaptive rebalance splits a value that holds much of the data. Without
    adaptive execution it could not, so rows then stay where they are.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df
    return df.hint("rebalance", partition_by)


def _fields(df: DataFrame, names: list[str]) -> StructType:
    return StructType([df.schema[n] for n in dict.fromkeys(names)])


def _on_batch_dates(
    spark: SparkSession, path: str, batch: DataFrame, columns: list[str], partition_by: str, fmt: str
) -> DataFrame:
    """Columns of the stored rows on the batch's dates (F3, C2): a list of
    dates while there are not too many, a semi join beyond that. Rows without
    a date count as one more date."""
    schema = _fields(batch, [*columns, partition_by])
    dates = date_list(batch.select(F.col(partition_by).alias("date")))
    if dates is not None:
        return snapshot(spark, path, schema, fmt, partition_by, [*dates, None])
    existing = snapshot(spark, path, schema, fmt)
    keys = batch.select(partition_by).distinct()
    dated = existing.join(keys, partition_by, "left_semi").select(existing.columns)
    return dated.unionByName(existing.filter(F.col(partition_by).isNull()))


def _without_stored_keyless(batch: DataFrame, stored: DataFrame, key: str, lineage: str) -> DataFrame:
    """The batch less the keyless rows that are stored already from the same file.

    A file's rows have fixed dates, so `stored` need only hold the batch's own
    dates. Mostly no file is known, which a scan of two columns tells. Rows of
    known files are compared as bags: n copies, of which m are stored, leave
    n - m. What is left counts as ingested now.
    """
    keyless = F.col(key).isNull()
    files = batch.filter(keyless).select(lineage).distinct()
    few = files.limit(MAX_FILE_LIST + 1).count() <= MAX_FILE_LIST
    held = stored.filter(keyless).join(F.broadcast(files) if few else files, lineage, "left_semi")
    seen = held.select(lineage).distinct()
    if seen.isEmpty():
        return batch
    seen = F.broadcast(seen) if few else seen
    rows = batch.filter(keyless)
    columns = [c for c in stored.columns if c != INGESTED_AT]
    left = rows.join(seen, lineage, "left_semi").select(columns).exceptAll(held.select(columns))
    for f in batch.schema.fields:
        if f.name not in columns:
            value = F.current_timestamp() if f.name == INGESTED_AT else F.lit(None)
            left = left.withColumn(f.name, value.cast(f.dataType))
    new = rows.join(seen, lineage, "left_anti").select(batch.columns)
    return batch.filter(~keyless).unionByName(new).unionByName(left)
