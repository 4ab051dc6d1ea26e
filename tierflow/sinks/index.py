"""A key index beside a stored table: which whole-number keys it holds.

The index is a view of the table's key column, kept in parquet: bitmaps, partitioned by
slices of key range, and a ledger of the data files that are in them. Before every lookup
the table's files are compared with the ledger, by name only:

* files that are not in the ledger, whoever wrote them and however the writer ended, are
  read (their key column alone) and added: bitmaps first, then the ledger. A run lost in
  between adds the same bits again, which changes nothing;
* a file of the ledger that is gone means that the table was rewritten: the index is built
  anew beside the old one, and used once its ledger is written.

So an insert never needs to touch the index, and a lookup never misses a stored key.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierflow import store
from tierflow.operators.bitmaps import BITMAP_BYTES, bitmaps, bucket_of, found_keys, is_whole, merged
from tierflow.operators.dates import date_list
from tierflow.operators.keys import BROADCAST_BYTES, ENTRY_BYTES, FIXED_WIDTH, KeyProfile
from tierflow.sources.files import has_files, snapshot

# Buckets per slice, that is per folder of bitmaps: 134 million keys.
SLICE_BUCKETS = 4_096
# Additions after which the bitmaps of a bucket are merged into one again.
MERGE_AFTER = 32
# Fewer keys than this for each bitmap, and a hash table of the keys would be smaller.
LEAST_KEYS = BITMAP_BYTES // (ENTRY_BYTES + FIXED_WIDTH) + 1
# Sparse keys do no harm up to this many bitmaps.
FEW_BITMAPS = 1_024
BITMAPS = "bucket long, bitmap binary, slice long"
LEDGER = "file string, run long"


@dataclass(frozen=True)
class KeyIndex:
    """The index at `root` of the column `key` of the table at `path`."""

    root: str
    path: str
    key: str = "id"
    partition_by: str = "date"
    fmt: str = "parquet"

    def lookup(self, batch: DataFrame, schema: StructType, profile: KeyProfile) -> DataFrame | None:
        """The batch's keys that the table holds, or None where the batch's keys are so
        sparse that bitmaps would be larger than the keys themselves.

        `schema` names the types of the key and partition columns. Only the bitmaps of the
        batch's buckets are read.
        """
        if not is_whole(batch, self.key):
            raise ValueError(f"{self.key} is not a whole number: such keys have no index")
        spark = batch.sparkSession
        version = self.refresh(spark, schema)
        if not profile.keys or version is None:
            return batch.select(self.key).limit(0)
        buckets = batch.filter(F.col(self.key).isNotNull()).select(F.bitmap_bucket_number(F.col(self.key).cast("bigint")).alias("bucket")).distinct()
        wanted = buckets.count()
        if wanted > FEW_BITMAPS and profile.keys < LEAST_KEYS * wanted:
            return None
        lo, hi = bucket_of(profile.lo), bucket_of(profile.hi)
        near = self._bitmaps(spark, version).filter(
            F.col("slice").between(lo // SLICE_BUCKETS, hi // SLICE_BUCKETS) & F.col("bucket").between(lo, hi)
        )
        few = wanted * 2 * ENTRY_BYTES <= BROADCAST_BYTES
        near = near.join(F.broadcast(buckets) if few else buckets, "bucket", "left_semi").select("bucket", "bitmap")
        return found_keys(batch, near, self.key, few=wanted * (BITMAP_BYTES + ENTRY_BYTES) <= BROADCAST_BYTES)

    def refresh(self, spark: SparkSession, schema: StructType) -> str | None:
        """Bring the index up to the table's files; its current version, or None while the
        table has none."""
        version = self.version(spark)
        if not has_files(spark, self.path):
            return version
        listed = self._listed(spark)
        if version is not None:
            ledger = self._ledger(spark, version)
            if not ledger.join(listed, "file", "left_anti").isEmpty():
                version = None
            else:
                listed = listed.join(ledger, "file", "left_anti")
        base = store.next_version(spark, self.root) if version is None else version
        # The same files for the bitmaps and the ledger, whatever arrives meanwhile.
        note = f"{self.root}/_new-{uuid.uuid4().hex}"
        listed.write.parquet(note)
        try:
            new = spark.read.schema(listed.schema).parquet(note)
            if not new.isEmpty():
                self._add(spark, base, new, schema, first=version is None)
        finally:
            store.remove(spark, note)
        return self._merged(spark, base) if version is not None else base

    def version(self, spark: SparkSession) -> str | None:
        """The latest version with a ledger."""
        for name in reversed(store.versions(spark, self.root)):
            if has_files(spark, f"{self.root}/{name}/files"):
                return name
        return None

    def _listed(self, spark: SparkSession) -> DataFrame:
        """Names of the table's files and their partitions; nothing of them is read."""
        files = spark.read.format("binaryFile").load(self.path)
        return files.select(F.col("_metadata.file_path").alias("file"), F.col(self.partition_by).cast("string").alias("partition"))

    def _ledger(self, spark: SparkSession, version: str) -> DataFrame:
        return spark.read.schema(LEDGER).parquet(f"{self.root}/{version}/files")

    def _bitmaps(self, spark: SparkSession, version: str) -> DataFrame:
        return spark.read.schema(BITMAPS).parquet(f"{self.root}/{version}/bitmaps")

    def _add(self, spark: SparkSession, version: str, new: DataFrame, schema: StructType, first: bool) -> None:
        fields = StructType([schema[self.key], schema[self.partition_by]])
        if first:
            rows = snapshot(spark, self.path, fields, self.fmt)
        else:
            dates = date_list(new.select(F.col("partition").alias("date")))
            values = None if dates is None else [*dates, None]
            rows = snapshot(spark, self.path, fields, self.fmt, self.partition_by, values)
        rows = rows.withColumn("file", F.col("_metadata.file_path")).join(new.select("file"), "file", "left_semi")
        self._write(bitmaps(rows, self.key), version)
        if first:
            self._check_density(spark, version)
        run = 0 if first else self._ledger(spark, version).agg(F.max("run")).first()[0] + 1
        new.select("file", F.lit(run).cast("long").alias("run")).write.mode("append").parquet(f"{self.root}/{version}/files")

    def _write(self, parts: DataFrame, version: str) -> None:
        sliced = parts.withColumn("slice", F.floor(F.col("bucket") / SLICE_BUCKETS).cast("long"))
        # Sorted, so that a lookup skips row groups within a slice as well.
        sorted_ = sliced.repartition("slice").sortWithinPartitions("slice", "bucket")
        sorted_.write.mode("append").partitionBy("slice").parquet(f"{self.root}/{version}/bitmaps")

    def _check_density(self, spark: SparkSession, version: str) -> None:
        row = self._bitmaps(spark, version).agg(F.count(F.lit(1)), F.sum(F.bitmap_count("bitmap"))).first()
        if row[0] > FEW_BITMAPS and row[1] < LEAST_KEYS * row[0]:
            raise ValueError(f"{row[1]} keys in {row[0]} bitmaps of {self.path}: keys so far apart have no index")

    def _merged(self, spark: SparkSession, version: str) -> str:
        """A version with one bitmap per bucket once there were many additions. The one
        before stays for those who read it; older ones go."""
        ledger = self._ledger(spark, version)
        if (ledger.agg(F.max("run")).first()[0] or 0) < MERGE_AFTER:
            return version
        after = store.next_version(spark, self.root)
        self._write(merged(self._bitmaps(spark, version)), after)
        ledger.withColumn("run", F.lit(0).cast("long")).write.parquet(f"{self.root}/{after}/files")
        for name in store.versions(spark, self.root):
            if name < version:
                store.remove(spark, f"{self.root}/{name}")
        return after
