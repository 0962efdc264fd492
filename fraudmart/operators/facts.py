"""append-only facts without duplicates.

Both are ``left_anti`` joins of the stage batch against the loaded fact.
Duplicates *inside* one batch are all kept, as in the source system.

For transactions the fact side is first narrowed to the batch's time range and
to the set of its days (one scalar subquery over the batch; a set of dates is
bounded by the calendar). When the fact is partitioned by ``trans_dt`` the set
prunes partitions at run time, so the anti-join reads the days that the batch
holds: one late row from three years ago costs one more day, not three years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.operators.spread import by_key

DEDUPE_MODES = (("trans_id", "trans_date"), ("trans_date",))


def append_blacklist(stage: DataFrame, fact: DataFrame, keep: str = "first") -> DataFrame:
    """stage rows whose passport is not in the fact yet.

    ``keep='first'`` (the source system): a later drop never changes a
    passport's entry date. ``keep='earliest'`` also appends a row that moves a
    known passport's first entry earlier, so rule 1 (which takes the earliest
    entry) starts on time.
    """
    if keep == "first":
        return stage.join(by_key(fact.select("passport_num")), "passport_num", "left_anti")
    if keep != "earliest":
        raise ValueError("keep must be 'first' or 'earliest'")
    first = fact.groupBy("passport_num").agg(F.min("entry_dt").alias("_first"))
    j = stage.join(by_key(first), "passport_num", "left")
    return (j.where(F.col("_first").isNull() | (F.col("entry_dt") < F.col("_first")))
            .drop("_first"))


def loaded_days(stage: DataFrame, fact: DataFrame, col: str = "trans_date",
                day_col: str = "trans_dt") -> DataFrame:
    """The rows of ``fact`` that a row of ``stage`` could repeat: from the batch's days,
    between its first and last time. Reads only those ``day_col`` partitions."""
    batch = stage.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"),
                               F.collect_set(F.to_date(col)).alias("days"))).scalar()
    near = fact.where((F.col(col) >= batch.getField("lo")) & (F.col(col) <= batch.getField("hi")))
    if day_col in fact.columns:
        near = near.where(F.array_contains(batch.getField("days"), F.col(day_col)))
    return near


def append_transactions(stage: DataFrame, fact: DataFrame,
                        dedupe_on: tuple[str, ...] = ("trans_id", "trans_date")) -> DataFrame:
    """stage rows with no loaded row under the dedupe key.

    ``('trans_id', 'trans_date')`` (default) drops re-delivered operations.
    ``('trans_date',)`` reproduces the source system, whose join compares
    the stage id with itself: any loaded row at the same timestamp hides a
    new operation, except that a NULL id never matches (always kept).
    """
    dedupe_on = tuple(dedupe_on)
    if dedupe_on not in DEDUPE_MODES:
        raise ValueError(f"dedupe_on must be one of {DEDUPE_MODES}")
    loaded = loaded_days(stage, fact)
    if dedupe_on == ("trans_id", "trans_date"):
        return stage.join(by_key(loaded.select("trans_id", "trans_date")),
                          ["trans_id", "trans_date"], "left_anti")
    tgt = loaded.select(F.col("trans_date").alias("_tgt_date")).distinct()
    cond = F.col("trans_id").isNotNull() & (F.col("trans_date") == F.col("_tgt_date"))
    return stage.join(by_key(tgt), cond, "left_anti")
