"""Digests of key buckets: what changed, without comparing keys.

Keys are dealt into a fixed number of buckets by hash. A bucket's digest is the
number of its rows and 128 bits of order-free sums of their hashes; it is a grouped
sum, so only one row per bucket and map task is shuffled. Two snapshots with equal
digests hold the same rows, however they are ordered; where digests differ the
bucket is compared key by key, as before. So a repeated row can cost a needless
comparison but never a wrong result. (Different contents of equal count and equal
128-bit sums are taken for equal.)
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.operators import scd2
from fraudmart.schemas import DimSpec

BUCKETS = 64
_SUMS = ("s0", "s1", "s2", "s3")

DIGESTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType()),
                        *[T.StructField(c, T.LongType()) for c in _SUMS]])


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    """A key's bucket; the same in every run and for every table of the key."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def digests(rows: DataFrame, key: str, buckets: int = BUCKETS,
            columns: Sequence[str] = ()) -> DataFrame:
    """``DIGESTS`` of the key and ``columns`` of each row (the key alone: who exists; with
    attributes: what they say). NULL keys are left out."""
    cols = [F.col(key), *[F.col(c) for c in columns]]
    marks = [c.isNull() for c in cols]   # xxhash64 skips NULLs
    a, b = F.xxhash64(*cols, *marks), F.xxhash64(F.lit(1), *marks, *cols)
    half = {"s0": F.shiftrightunsigned(a, 32), "s1": a.bitwiseAND(F.lit(0xFFFFFFFF)),
            "s2": F.shiftrightunsigned(b, 32), "s3": b.bitwiseAND(F.lit(0xFFFFFFFF))}
    return (rows.where(F.col(key).isNotNull())
            .select(bucket_of(key, buckets).alias("bucket"), *[v.alias(k) for k, v in half.items()])
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in _SUMS]))


def differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """``bucket``: those whose digests are not the same in both."""
    o = old.select("bucket", F.struct("n", *_SUMS).alias("old"))
    n = new.select("bucket", F.struct("n", *_SUMS).alias("new"))
    return o.join(n, "bucket", "full_outer").where(
        ~F.col("old").eqNullSafe(F.col("new"))).select("bucket")


def in_buckets(rows: DataFrame, key: str, wanted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``wanted`` (``bucket``: at most ``buckets`` rows, so it is broadcast)."""
    few = F.broadcast(wanted.select(F.col("bucket").alias("_bucket")).distinct())
    return rows.join(few, bucket_of(key, buckets) == F.col("_bucket"), "left_semi")


def deleted_by_digest(hist: DataFrame, keys: DataFrame, before: DataFrame, spec: DimSpec,
                      run_date: _dt.date, buckets: int = BUCKETS) -> DataFrame:
    """D5 where ``before`` holds the digests of the last snapshot: the tombstones of
    ``scd2_tombstones``, comparing only the buckets whose digest changed. Live keys must have
    been in that snapshot, or be in a bucket that differs."""
    wanted = differing(before, digests(keys, spec.key, buckets))
    return scd2.scd2_tombstones(in_buckets(hist, spec.key, wanted, buckets),
                                in_buckets(keys, spec.key, wanted, buckets), spec, run_date)
