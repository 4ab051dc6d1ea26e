"""Insert-if-absent as DataFrame steps.

The rows of a batch split in two. Rows without a key match nothing and always
pass. Rows with a key pass when the table lacks the key; on request only the
first row per key does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Keys are broadcast only while their size, measured on the batch, stays under
# this bound.
BROADCAST_BYTES = 64 * 1024 * 1024
# Memory per key of a broadcast hash table on top of the key itself.
ENTRY_BYTES = 64
# Bytes of a key that is neither text nor binary, at most.
FIXED_WIDTH = 16
# A key is hot when it has more rows than both of these allow. At most
# HOT_FRACTION keys can be hot, which bounds what is broadcast for them.
HOT_FRACTION = 1_000
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class KeyProfile:
    """What one key-only pass over a batch tells about it."""

    rows: int
    null_rows: int
    keys: int
    repeated: int
    lo: Any
    hi: Any
    hottest: int
    width: int
    # Range of the keys with more than one row.
    repeated_lo: Any = None
    repeated_hi: Any = None

    def fits(self, keys: int, limit: int) -> bool:
        """Whether that many keys make a broadcast of at most `limit` bytes."""
        return keys * (self.width + ENTRY_BYTES) <= limit


def key_counts(batch: DataFrame, key: str = "id") -> DataFrame:
    """Rows per key; combines map-side, so a hot key costs one row per task."""
    return batch.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def key_profile(batch: DataFrame, key: str = "id") -> KeyProfile:
    """Profile of the batch's keys: one action, one row to the driver."""
    k, n = F.col(key), F.col("n")
    row = (
        key_counts(batch, key)
        .agg(
            F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(k.isNull(), n)), F.lit(0)).alias("null_rows"),
            F.count(k).alias("keys"),
            F.count(F.when(k.isNotNull() & (n > 1), n)).alias("repeated"),
            F.min(k).alias("lo"),
            F.max(k).alias("hi"),
            F.coalesce(F.max(F.when(k.isNotNull(), n)), F.lit(0)).alias("hottest"),
            _width(batch, key).alias("width"),
            F.min(F.when(n > 1, k)).alias("repeated_lo"),
            F.max(F.when(n > 1, k)).alias("repeated_hi"),
        )
        .first()
    )
    return KeyProfile(**row.asDict())


def in_key_range(existing: DataFrame, key: str, profile: KeyProfile) -> DataFrame:
    """Stored keys between the least and the greatest of the batch."""
    return existing.select(key).filter(F.col(key).between(profile.lo, profile.hi))


def broadcast_size(keys: DataFrame, key: str) -> int:
    """Bytes a broadcast of these keys takes; one key-only scan."""
    row = keys.agg(F.count(F.lit(1)).alias("n"), _width(keys, key).alias("width")).first()
    return row["n"] * (row["width"] + ENTRY_BYTES)


def _width(df: DataFrame, key: str) -> Column:
    """Aggregate: bytes of the widest key."""
    if df.schema[key].dataType.typeName() in ("string", "binary"):
        return F.coalesce(F.max(F.octet_length(key)), F.lit(0))
    return F.lit(FIXED_WIDTH)


def first_per_key(
    rows: DataFrame, key: str = "id", order_by: Sequence[str] = ("time", "_filename")
) -> DataFrame:
    """The first row of every key by `order_by`, remaining columns as tie-break (Q1).

    Spark limits each key to its first row before the shuffle as well as after
    it (a partial window group limit), so the copies of a hot key never meet in
    one task. The survivor does not depend on partitioning. It does not depend on
    how a stream is cut into batches either when `order_by` is the order of
    arrival, as in :func:`~tierflow.streaming.ingest_events`. Unknown values come
    last.
    """
    ahead = [c for c in order_by if c in rows.columns and c != key]
    rest = [c for c, kind in rows.dtypes if c not in (key, *ahead) and "map<" not in kind and kind != "variant"]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*(F.col(c).asc_nulls_last() for c in ahead), *rest))
    return rows.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def absent_rows(
    batch: DataFrame,
    existing: DataFrame,
    key: str = "id",
    profile: KeyProfile | None = None,
    dedupe: bool = True,
    order_by: Sequence[str] = ("time", "_filename"),
    known_size: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows of `batch` to insert into the table whose keys `existing` holds.

    With a `profile` the key range of the batch becomes a filter on the scan of
    `existing` (row-group pruning when keys grow with time), and the join form
    follows from the measured size:

    * few keys: they are broadcast to `existing`, which is neither shuffled nor
      sorted; what matches is no larger and is broadcast back to the batch;
    * many keys, but few stored ones in their range (`known_size`, as measured by
      :func:`broadcast_size`): those are broadcast to the batch. This is the way
      of a long back-fill, whose batches hardly overlap;
    * many keys on both sides: one shuffle of each on the key. Stored keys are made
      distinct first, which leaves one row per key and task of those that the table
      holds many times. Hot keys of the batch cannot appear
      once duplicates are removed; when they are kept, the hot ones take the
      broadcast form and the others the shuffle.
    """
    if profile is None:
        keyed, keyless = _by_key_presence(batch, key)
        candidates = first_per_key(keyed, key, order_by) if dedupe else keyed
        return _anti(candidates, existing.select(key).distinct(), key).unionByName(keyless)

    known = in_key_range(existing, key, profile)
    if profile.fits(profile.keys, broadcast_bytes):
        # Rows without a key match nothing and are not moved: no need to split.
        rows = _without_copies(batch, key, profile, order_by, broadcast_bytes) if dedupe else batch
        keys = batch.select(key).filter(F.col(key).isNotNull())
        return _anti_by_broadcast(rows, known, keys.distinct() if profile.repeated else keys, key)

    keyed, keyless = _by_key_presence(batch, key) if profile.null_rows else (batch, None)
    limit = max(hot_rows, profile.rows // HOT_FRACTION)
    if dedupe:
        keyed = _without_copies(keyed, key, profile, order_by, broadcast_bytes)
    if known_size is not None and known_size <= broadcast_bytes:
        fresh = _anti(keyed, F.broadcast(known), key)
    elif not dedupe and profile.hottest > limit:
        hot = _keys_above(keyed, limit, key)
        fresh = _anti_by_broadcast(_semi(keyed, hot, key), known, hot, key).unionByName(
            _anti(_anti(keyed, F.broadcast(hot), key), known.distinct(), key)
        )
    else:
        fresh = _anti(keyed, known.distinct(), key)
    return fresh if keyless is None else fresh.unionByName(keyless)


def _by_key_presence(batch: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return batch.filter(F.col(key).isNotNull()), batch.filter(F.col(key).isNull())


def _without_copies(
    rows: DataFrame, key: str, profile: KeyProfile, order_by: Sequence[str], broadcast_bytes: int
) -> DataFrame:
    """One row per key. While the repeated keys are few enough to broadcast,
    only their rows are shuffled and sorted; the others, and rows without a
    key, stay in place. Beyond that, `rows` must all have a key."""
    if not profile.repeated:
        return rows
    if profile.fits(profile.repeated, broadcast_bytes):
        # The range skips row groups without copies in the second read of the rows.
        near = rows.filter(F.col(key).between(profile.repeated_lo, profile.repeated_hi))
        repeated = _keys_above(near, 1, key)
        single = _anti(rows, F.broadcast(repeated), key)
        return single.unionByName(first_per_key(_semi(near, repeated, key), key, order_by))
    return first_per_key(rows, key, order_by)


def _keys_above(rows: DataFrame, count: int, key: str) -> DataFrame:
    return key_counts(rows.filter(F.col(key).isNotNull()), key).filter(F.col("n") > count).select(key)


def _anti_by_broadcast(rows: DataFrame, known: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Anti join of rows whose keys all lie in the bounded set `keys`."""
    matched = _semi(known, keys, key).distinct()
    return _anti(rows, F.broadcast(matched), key)


def _semi(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return rows.join(F.broadcast(keys), key, "left_semi").select(rows.columns)


def _anti(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return rows.join(keys, key, "left_anti").select(rows.columns)
