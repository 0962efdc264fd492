"""As-of join: each fact with the version of a key that was in force on its day.

A range join pairs a fact with every version of its key before the dates are
compared, so a key that changes daily multiplies its facts by its versions.
Here the facts' distinct (key, day) pairs and the versions' starts go into one
union; in a key's order of days the last start seen so far is the version in
force (``last`` ignoring NULLs), and it holds if its end is not before the day.
The facts then meet exactly one row per (key, day): joined rows never exceed
facts, whatever the number of versions.

* The pairs are distinct before the shuffle (map-side), so a key with a third of
  all facts is one row per day, and a key's window holds at most its days and its
  versions, both bounded by the calendar.
* The facts' rows are not sorted or windowed; they meet the pairs in one equi-join
  on (key, day), which splits a hot key by day (``spread``: further, see there).
* Versions must not overlap (type-2 history). Two versions of a key in force on
  one day stop the job, naming the key, instead of losing one. An empty period
  (end before start, as after two changes on one day) is in force on no day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.operators.spread import Hot, spread_join


def in_force(pairs: DataFrame, versions: DataFrame, key: str, day: str, start: str, end: str,
             values: Sequence[str]) -> DataFrame:
    """``pairs`` (distinct ``key, day`` and more columns) with ``values`` of the version in
    force, ``found`` telling whether there is one. One shuffle, by key."""
    carried = [c for c in pairs.columns if c not in (key, day)]
    state = F.struct(F.col(end).alias("_until"), *[F.col(v) for v in values])
    known = versions.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end)))
    asked = pairs.select(key, F.col(day).alias("_day"), F.lit(1).alias("_asks"),
                         F.struct(F.lit(1).alias("_one"), *carried).alias("_pair"))
    starts = known.select(key, F.col(start).alias("_day"), F.lit(0).alias("_asks"),
                          state.alias("_state"))
    both = asked.unionByName(starts, allowMissingColumns=True)
    so_far = Window.partitionBy(key).orderBy("_day", "_asks")
    both = both.withColumns({
        "_held": F.last("_state", ignorenulls=True).over(so_far.rowsBetween(
            Window.unboundedPreceding, Window.currentRow)),
        "_before": F.last("_state", ignorenulls=True).over(so_far.rowsBetween(
            Window.unboundedPreceding, -1))})
    alone = F.assert_true(
        (F.col("_asks") == 1) | F.col("_before").isNull() | (F.col("_before._until") < F.col("_day")),
        F.concat(F.lit(f"versions of one {key} overlap: "), F.col(key).cast("string")))
    holds = F.col("_held").isNotNull() & (F.col("_held._until") >= F.col("_day"))
    return (both.where(alone.isNull() & (F.col("_asks") == 1))
            .select(key, F.col("_day").alias(day), *[F.col(f"_pair.{c}").alias(c) for c in carried],
                    holds.alias("found"),
                    *[F.when(holds, F.col(f"_held.{v}")).alias(v) for v in values]))


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, day: Column, start: str, end: str,
               values: Sequence[str], how: str = "inner", version_key: str | None = None,
               hot: Hot | None = None) -> DataFrame:
    """``facts`` with ``values`` of the version of ``key`` in force on ``day`` (a date).
    ``how``: 'inner' drops facts without one, 'left' keeps them with NULLs."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    dated = facts.withColumn("_on", day)
    pairs = (dated.where(F.col(key).isNotNull() & F.col("_on").isNotNull())
             .select(key, "_on").distinct())
    named = versions if version_key in (None, key) else versions.withColumnRenamed(version_key, key)
    found = in_force(pairs, named, key, "_on", start, end, values)
    found = found.where("found").drop("found")
    return spread_join(dated, found, [key, "_on"], how, hot).drop("_on")
