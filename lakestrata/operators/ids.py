"""Dense surrogate ids without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def key_hash_bucket(columns: Sequence[str], buckets: int) -> Column:
    """Bucket of a row key, a power of two of them: the leading bits of its hash, so buckets are in the order of hashes."""
    if buckets & (buckets - 1) or buckets < 1:
        raise ValueError("buckets must be a power of two")
    if buckets == 1:
        # never null, as a bit mask, and so adds no null filter below the joins
        return _key_hash(columns).bitwiseAND(F.lit(0)).cast("int")
    shift = 64 - (buckets.bit_length() - 1)
    return (F.shiftright(_key_hash(columns), shift) + F.lit(buckets // 2)).cast("int")


def bucket_count(rows: int, rows_per_bucket: int) -> int:
    """The power of two of buckets that hold ``rows_per_bucket`` rows or fewer on average, 2^20 at most."""
    return 1 << min(20, max(0, -(-rows // rows_per_bucket) - 1).bit_length())


def dense_id(
    df: DataFrame, name: str, keys: Sequence[str] | None = None,
    buckets: int | None = None, bucket: Column | None = None, rows_per_bucket: int = 1 << 18,
) -> DataFrame:
    """Ids 0..n-1 for rows unique on ``keys`` (all columns if not given).

    Rows are in order of the key's hash, then of the key, and cut into ranges of that hash:
    hashes are spread evenly, so equal ranges are its quantiles. An id is the number of rows
    in earlier buckets plus the row's rank inside its bucket. So ids are a function of the
    rows alone: neither partitioning nor the number of buckets changes them, and they
    survive task retries with no checkpoint. Only the bucket counts meet in one place, and
    only they are broadcast. A bucket is sorted in one task; unless ``buckets`` tells their
    number, it follows from an estimate of the different keys (one pass, a mergeable sketch
    of some kB) so that a bucket has about ``rows_per_bucket`` rows.

    A ``bucket`` of the caller's must be an integer from 0 to below ``buckets`` (4096); another
    value, or none, is an error; rows of a bucket are then in order of the key.
    """
    keys = list(keys or df.columns)
    within = [F.col(f"`{k}`") for k in keys]
    if bucket is None:
        if buckets is None:
            about = df.agg(F.approx_count_distinct(_key_hash(keys))).first()[0]
            buckets = bucket_count(about, rows_per_bucket)
        bucket = key_hash_bucket(keys, buckets)
        within = [_key_hash(keys), *within]
    else:
        buckets = buckets or 4096
        number = bucket.cast("int")
        bucket = F.when((number >= 0) & (number < buckets), number).otherwise(F.raise_error(F.lit(f"bucket outside 0..{buckets - 1}")).cast("int"))
    tagged = df.withColumn("_bucket", bucket)
    counts = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # Running total over at most `buckets` rows: the one place where a global order is needed.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*within))
    return (
        tagged.withColumn("_rank", rank)
        .join(F.broadcast(offsets), ["_bucket"], "inner")
        .select((F.col("_offset") + F.col("_rank") - 1).alias(name), *[F.col(f"`{c}`") for c in df.columns])
    )


def distinct_with_id(df: DataFrame, name: str, buckets: int | None = 4096) -> DataFrame:
    """Distinct rows with a dense id; repeats collapse map-side before anything is ranked.

    With ``buckets=None`` their number is estimated from ``df`` itself, before the repeats go.
    """
    if buckets is None:
        buckets = bucket_count(df.agg(F.approx_count_distinct(_key_hash(df.columns))).first()[0], 1 << 18)
    return dense_id(df.distinct(), name, buckets=buckets)
