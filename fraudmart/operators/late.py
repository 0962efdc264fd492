"""Histories that do not depend on the order in which changes arrive (D3, Q7).

The source system closes the open version at ``update_dt - 1`` whatever the dates
are, so a change dated before the open version's start leaves periods that end
before they begin. Here each delivered row is an *observation*: from its date on,
the key looks like this. The observations are kept as an append-only log, and a
key's history is what they say in order of their dates: a late change cuts the
version that it falls into, and neighbours that say the same merge (gaps and
islands). Only keys that a day touches are built again; the rest of the history
passes through.

* The date of an observation is the update date, or the create date where there is
  none; the first observation reaches back to the key's earliest create date.
* Of several observations of one key and date one counts: a deletion before a live
  row, then the greatest ``_seq`` (optional column), then the greatest attributes.
  Arrival plays no part, so any order of the same deliveries gives the same history.
* A deletion is an observation of the run that missed the key in a full snapshot;
  its version carries the attributes in force before it.
* A key's window holds one row per date, as equal dates meet before it (map-side
  partial maximum), so no key is larger than the calendar.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.functions.columns import is_live, is_open
from fraudmart.operators.spread import by_key
from fraudmart.schemas import DELETED_FLAG, LIVE_FLAG, OPEN_DATE, DimSpec


def log_schema(spec: DimSpec) -> T.StructType:
    """Key, attributes, and ``seen_from, born, deleted_flg, seq``."""
    fields = [spec.schema[c] for c in spec.columns]
    return T.StructType([*fields, T.StructField("seen_from", T.DateType()),
                         T.StructField("born", T.DateType()),
                         T.StructField("deleted_flg", T.StringType()),
                         T.StructField("seq", T.LongType())])


def observations(stage: DataFrame, spec: DimSpec) -> DataFrame:
    """The log rows of a delivery. Rows without a key or a date say nothing (a NULL key goes
    to quarantine, see ``scd2.quarantine_keys``)."""
    seq = F.col("_seq").cast("long") if "_seq" in stage.columns else F.lit(0).cast("long")
    at = F.coalesce(F.col(spec.change_from), F.col(spec.new_from))
    born = F.least(at, F.coalesce(F.col(spec.new_from), at))
    return (stage.where(F.col(spec.key).isNotNull() & at.isNotNull())
            .select(*spec.columns, at.alias("seen_from"), born.alias("born"),
                    F.lit(LIVE_FLAG).alias("deleted_flg"), seq.alias("seq")))


def log_of_history(hist: DataFrame, spec: DimSpec) -> DataFrame:
    """The log that a history amounts to, to begin with where none was kept."""
    return hist.where(F.col("effective_from") <= F.col("effective_to")).select(
        *spec.columns, F.col("effective_from").alias("seen_from"),
        F.col("effective_from").alias("born"), "deleted_flg", F.lit(0).cast("long").alias("seq"))


def timeline(log: DataFrame, spec: DimSpec) -> DataFrame:
    """The history that a log says, for all its keys. Two shuffles at most: equal dates meet by
    (key, date), a key's dates by key."""
    key, attrs = spec.key, list(spec.attrs)
    gone = F.col("deleted_flg") == DELETED_FLAG
    best = F.max(F.struct(gone.alias("gone"), "seq", *attrs)).alias("x")
    dated = log.groupBy(key, "seen_from").agg(best, F.min("born").alias("born"))
    by_key = Window.partitionBy(key).orderBy("seen_from")
    upto = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a deletion shows what was in force before it
    state = F.last(F.when(~F.col("x.gone"), F.struct(*[F.col(f"x.{a}") for a in attrs])),
                   ignorenulls=True).over(upto)
    dated = dated.select(
        key, F.when(F.row_number().over(by_key) == 1, F.least("seen_from", F.min("born").over(
            Window.partitionBy(key)))).otherwise(F.col("seen_from")).alias("seen_from"),
        F.col("x.gone").alias("gone"), state.alias("state")).where(F.col("state").isNotNull())
    said = F.struct("gone", "state")
    first = dated.withColumn("_prev", F.lag(said).over(by_key)).where(
        F.col("_prev").isNull() | ~said.eqNullSafe(F.col("_prev")))
    end = F.coalesce(F.date_sub(F.lead("seen_from").over(by_key), 1), F.lit(OPEN_DATE))
    return first.select(
        key, *[F.col(f"state.{a}").alias(a) for a in attrs],
        F.col("seen_from").alias("effective_from"), end.alias("effective_to"),
        F.when(F.col("gone"), F.lit(DELETED_FLAG)).otherwise(F.lit(LIVE_FLAG)).alias("deleted_flg"))


def rebuilt(hist: DataFrame, log: DataFrame, touched: DataFrame, spec: DimSpec) -> DataFrame:
    """``hist`` with the keys of ``touched`` built again from ``log``."""
    keys = touched.select(spec.key).distinct()
    again = timeline(log.join(by_key(keys), spec.key, "left_semi"), spec)
    rest = hist.join(by_key(keys), spec.key, "left_anti").select(*spec.history_columns)
    return rest.unionByName(again.select(*spec.history_columns))


def apply_late(hist: DataFrame, log: DataFrame, stage: DataFrame, spec: DimSpec,
               run_date: _dt.date, keys: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One day: the history after it, and the observations to append to the log. ``keys``: the
    full key snapshot, None where none arrived (nothing is deleted). Both results are plans
    over the inputs: write them before the next day, as a daily run does."""
    new = observations(stage, spec)
    whole = log.unionByName(new)
    after = rebuilt(hist, whole, new, spec)
    if keys is None:
        return after, new
    live = after.where(is_open() & is_live() & (F.col("effective_from") <= F.lit(run_date)))
    missed = live.join(by_key(keys.select(spec.key)), spec.key, "left_anti").select(
        *spec.columns, F.lit(run_date).alias("seen_from"), F.lit(run_date).alias("born"),
        F.lit(DELETED_FLAG).alias("deleted_flg"), F.lit(0).cast("long").alias("seq"))
    return rebuilt(after, whole.unionByName(missed), missed, spec), new.unionByName(missed)
