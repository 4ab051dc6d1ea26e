"""Sets of whole-number keys as bitmaps of 32,768 keys each.

A bitmap takes 4 KB however many of its keys are there: an eighth of a byte for each of a
run of keys, where a hash table takes about 80 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys and bytes of a bitmap of Spark's functions.
BITMAP_KEYS = 32_768
BITMAP_BYTES = 4_096
WHOLE = ("tinyint", "smallint", "int", "bigint")


def is_whole(df: DataFrame, key: str) -> bool:
    """Whether the keys of a frame are whole numbers."""
    return df.schema[key].dataType.simpleString() in WHOLE


def bucket_of(value: int) -> int:
    """Bitmap of a key, as :func:`pyspark.sql.functions.bitmap_bucket_number` has it."""
    return 1 + (value - 1) // BITMAP_KEYS if value > 0 else -(-value // BITMAP_KEYS)


def bitmaps(keys: DataFrame, key: str) -> DataFrame:
    """`bucket` and `bitmap` of the keys; combines map-side. Rows without a key are left out."""
    value = F.col(key).cast("bigint")
    present = keys.filter(F.col(key).isNotNull())
    return present.groupBy(F.bitmap_bucket_number(value).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bitmap")
    )


def merged(parts: DataFrame) -> DataFrame:
    """One bitmap per bucket from several."""
    return parts.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def holds(bitmap: str | Column, position: Column) -> Column:
    """Whether a bitmap has the bit at a position."""
    byte = F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int")) == 1


def found_keys(keys: DataFrame, parts: DataFrame, key: str, few: bool) -> DataFrame:
    """The distinct keys of a frame that some bitmaps hold.

    `few` says that the bitmaps of the frame's buckets are few enough to broadcast.
    Otherwise both sides are shuffled on the bucket, which has at most 32,768 distinct
    keys.
    """
    value = F.col(key).cast("bigint")
    wanted = keys.filter(F.col(key).isNotNull()).select(key).distinct().withColumn("bucket", F.bitmap_bucket_number(value))
    whole = merged(parts)
    pairs = wanted.join(F.broadcast(whole) if few else whole, "bucket")
    return pairs.filter(holds(F.col("bitmap"), F.bitmap_bit_position(value))).select(key)
