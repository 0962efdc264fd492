"""Type-2 history of a dimension as pure DataFrame functions.

History rows carry ``effective_from``, ``effective_to`` (inclusive dates,
``9999-12-31`` = open) and ``deleted_flg`` ('N' live, 'Y' tombstone).

Two forms are provided:

* The step operators ``scd2_new`` (D1), ``scd2_changed`` (D2/D4),
  ``scd2_closed`` (D3), ``scd2_tombstones`` (D5) and ``scd2_close_deleted``
  (D6) — each is one join and returns exactly the rows that step inserts or
  rewrites. They are what a daily change report reads.
* ``scd2_apply`` (D7) — the whole day in one shuffle. Open history rows, stage
  rows and snapshot keys are unioned and grouped by key (partial aggregation
  collapses duplicate snapshot keys map-side, so a hot key never reaches the
  shuffle as many rows); per key the new / changed / deleted outcome is
  decided in the order D1 → D2+D3 → D5+D6 and the touched rows are emitted
  with ``explode``. Closed history rows never enter the shuffle: they pass
  through unchanged, so a day's cost is proportional to the open slice, not
  to the whole history.

Stage input: key, attributes, and the columns named by the ``DimSpec``
(``create_dt``/``update_dt`` or, for full snapshots, ``update_dt`` = load
date). Of duplicate stage keys the row with the highest ``_seq`` (an optional
column), then the latest update, then the latest creation wins; full ties fall
back to the largest attribute tuple. ``duplicate_stage_rows`` lists the others.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.functions.columns import day_before, differs, is_live, is_open
from fraudmart.operators.spread import by_key
from fraudmart.schemas import DELETED_FLAG, LIVE_FLAG, OPEN_DATE, DimSpec

MISSING_SNAPSHOT_POLICIES = ("skip", "delete")


def _change_from(spec: DimSpec, null_update: str) -> Column:
    """``effective_from`` of a changed key. The source system uses
    ``update_dt`` raw (NULL when the row qualified by ``create_dt``);
    ``null_update='coalesce'`` falls back to ``new_from``."""
    c = F.col(spec.change_from)
    if null_update == "raw" or spec.change_from == spec.new_from:
        return c
    if null_update != "coalesce":
        raise ValueError("null_update must be 'coalesce' or 'raw'")
    return F.coalesce(c, F.col(spec.new_from))


def _version(spec: DimSpec, attrs: list[Column], start: Column, end: Column,
             flag: Column) -> list[Column]:
    return [*attrs, start.alias("effective_from"), end.alias("effective_to"),
            flag.alias("deleted_flg")]


# --- step operators (one join each) ------------------------------------------

def scd2_new(hist: DataFrame, stage: DataFrame, spec: DimSpec) -> DataFrame:
    """Stage rows whose key is nowhere in history → open 'N' versions."""
    new = stage.join(by_key(hist.select(spec.key)), spec.key, "left_anti")
    return new.select(*_version(spec, [F.col(c) for c in spec.columns], F.col(spec.new_from),
                                F.lit(OPEN_DATE), F.lit(LIVE_FLAG)))


def _matched_open(hist: DataFrame, stage: DataFrame, spec: DimSpec) -> DataFrame:
    """Stage ⋈ open history on key, where an attribute differs (NULL-safe) or
    the open version is a tombstone (D4: a deleted key that reappears)."""
    h = hist.where(is_open()).select(
        spec.key, *[F.col(a).alias(f"h_{a}") for a in spec.attrs],
        F.col("effective_from").alias("h_from"), F.col("deleted_flg").alias("h_flag"))
    j = stage.join(by_key(h), spec.key)
    return j.where(differs(spec.attrs, [f"h_{a}" for a in spec.attrs])
                   | (F.col("h_flag") == DELETED_FLAG))


def scd2_changed(hist: DataFrame, stage: DataFrame, spec: DimSpec,
                 null_update: str = "coalesce") -> DataFrame:
    """D2 (+D4): the new open 'N' version of every changed or restored key."""
    m = _matched_open(hist, stage, spec)
    return m.select(*_version(spec, [F.col(c) for c in spec.columns],
                              _change_from(spec, null_update), F.lit(OPEN_DATE), F.lit(LIVE_FLAG)))


def scd2_resurrected(hist: DataFrame, stage: DataFrame, spec: DimSpec,
                     null_update: str = "coalesce") -> DataFrame:
    """D4 alone: new versions of keys whose open version is a tombstone."""
    m = _matched_open(hist, stage, spec).where(F.col("h_flag") == DELETED_FLAG)
    return m.select(*_version(spec, [F.col(c) for c in spec.columns],
                              _change_from(spec, null_update), F.lit(OPEN_DATE), F.lit(LIVE_FLAG)))


def scd2_closed(hist: DataFrame, stage: DataFrame, spec: DimSpec,
                null_update: str = "coalesce") -> DataFrame:
    """D3: the superseded open versions, closed the day before the change."""
    m = _matched_open(hist, stage, spec)
    return m.select(*_version(
        spec, [F.col(spec.key)] + [F.col(f"h_{a}").alias(a) for a in spec.attrs],
        F.col("h_from"), day_before(_change_from(spec, null_update)), F.col("h_flag")))


def _gone(hist: DataFrame, keys: DataFrame, spec: DimSpec) -> DataFrame:
    live_open = hist.where(is_open() & is_live())
    return live_open.join(by_key(keys.select(spec.key)), spec.key, "left_anti")


def scd2_tombstones(hist: DataFrame, keys: DataFrame, spec: DimSpec,
                    run_date: _dt.date) -> DataFrame:
    """Open live keys missing from the full key snapshot → open 'Y'
    tombstone carrying the last attributes, valid from ``run_date``."""
    return _gone(hist, keys, spec).select(*_version(
        spec, [F.col(c) for c in spec.columns], F.lit(run_date), F.lit(OPEN_DATE),
        F.lit(DELETED_FLAG)))


def scd2_close_deleted(hist: DataFrame, keys: DataFrame, spec: DimSpec,
                       run_date: _dt.date) -> DataFrame:
    """The live version of a deleted key, closed the day before."""
    return _gone(hist, keys, spec).select(*_version(
        spec, [F.col(c) for c in spec.columns], F.col("effective_from"),
        day_before(F.lit(run_date)), F.col("deleted_flg")))


def _precedence(stage: DataFrame, spec: DimSpec) -> list[Column]:
    """What decides between rows of one stage key, the greatest first (NULL is least)."""
    seq = F.col("_seq") if "_seq" in stage.columns else F.lit(0)
    return [seq.alias("seq"), F.col(spec.change_from).alias("updated"),
            F.col(spec.new_from).alias("created")]


def duplicate_stage_rows(stage: DataFrame, spec: DimSpec) -> DataFrame:
    """Stage rows that lose to another row of their key (equal rows are no loss)."""
    ranked = stage.where(F.col(spec.key).isNotNull()).withColumn(
        "_rank", F.struct(*_precedence(stage, spec), *[F.col(a) for a in spec.attrs]))
    best = ranked.groupBy(spec.key).agg(F.max("_rank").alias("_best"))
    return (ranked.join(by_key(best), spec.key).where(~F.col("_rank").eqNullSafe(F.col("_best")))
            .drop("_rank", "_best"))


# --- the whole day in one shuffle ---------------------------------------------

def scd2_touched(hist: DataFrame, stage: DataFrame, spec: DimSpec, run_date: _dt.date,
                 keys: DataFrame | None = None, missing_snapshot: str = "skip",
                 null_update: str = "coalesce") -> DataFrame:
    """The rewritten open slice: every open version after the day (changed or
    not) plus the versions this day closed. Adds ``change`` =
    unchanged|new|changed|restored|deleted (for run statistics).

    Stage rows with a NULL key are ignored here (see ``quarantine_keys``);
    duplicate stage keys collapse to one (see the module's text).
    """
    if missing_snapshot not in MISSING_SNAPSHOT_POLICIES:
        raise ValueError(f"missing_snapshot must be one of {MISSING_SNAPSHOT_POLICIES}")
    key, attrs = spec.key, list(spec.attrs)
    s_struct = F.struct(*_precedence(stage, spec), *[F.col(a) for a in attrs],
                        F.col(spec.new_from).alias("nf"),
                        _change_from(spec, null_update).alias("cf"))
    h_struct = F.struct(*[F.col(a) for a in attrs], F.col("effective_from").alias("hf"),
                        F.col("deleted_flg").alias("hflag"))
    s_type = stage.select(s_struct.alias("s")).schema["s"].dataType
    h_type = hist.select(h_struct.alias("h")).schema["h"].dataType
    no_s, no_h = F.lit(None).cast(s_type), F.lit(None).cast(h_type)

    parts = [
        hist.where(is_open()).select(key, no_s.alias("s"), h_struct.alias("h"),
                                     F.lit(False).alias("seen")),
        stage.where(F.col(key).isNotNull()).select(key, s_struct.alias("s"), no_h.alias("h"),
                                                   F.lit(False).alias("seen")),
    ]
    snapshot = keys is not None or missing_snapshot == "delete"
    if keys is not None:
        parts.append(keys.where(F.col(key).isNotNull()).select(
            key, no_s.alias("s"), no_h.alias("h"), F.lit(True).alias("seen")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    g = u.groupBy(key).agg(F.max("s").alias("s"), F.max("h").alias("h"),
                           F.max("seen").alias("seen"), F.count("h").alias("n_open"))

    has_s, has_h = F.col("s").isNotNull(), F.col("h").isNotNull()
    s_attrs = [F.col(f"s.{a}") for a in attrs]
    h_attrs = [F.col(f"h.{a}") for a in attrs]
    is_new = has_s & ~has_h
    is_changed = has_s & has_h & (differs(s_attrs, h_attrs) | (F.col("h.hflag") == DELETED_FLAG))
    replaced = is_new | is_changed
    cur_attrs = [F.when(replaced, s).otherwise(h) for s, h in zip(s_attrs, h_attrs)]
    cur_from = (F.when(is_new, F.col("s.nf")).when(is_changed, F.col("s.cf"))
                .otherwise(F.col("h.hf")))
    cur_flag = F.when(replaced, F.lit(LIVE_FLAG)).otherwise(F.col("h.hflag"))
    delete = (F.lit(snapshot) & ~F.coalesce(F.col("seen"), F.lit(False))
              & (has_s | has_h) & (cur_flag == LIVE_FLAG))
    change = (F.when(delete, F.lit("deleted"))
              .when(is_new, F.lit("new"))
              .when(is_changed & (F.col("h.hflag") == DELETED_FLAG), F.lit("restored"))
              .when(is_changed, F.lit("changed"))
              .otherwise(F.lit("unchanged")))

    def row(attr_cols, start, end, flag):
        return F.struct(*[c.alias(a) for c, a in zip(attr_cols, attrs)],
                        start.alias("effective_from"), end.alias("effective_to"),
                        flag.alias("deleted_flg"))

    rows = F.array(
        # D3: the superseded version closes the day before the change
        F.when(is_changed, row(h_attrs, F.col("h.hf"), day_before(F.col("s.cf")),
                               F.col("h.hflag"))),
        # the version open after D1/D2, closed by D6 when the key is gone
        F.when(has_s | has_h, row(cur_attrs, cur_from,
                                  F.when(delete, day_before(F.lit(run_date)))
                                  .otherwise(F.lit(OPEN_DATE)), cur_flag)),
        # tombstone
        F.when(delete, row(cur_attrs, F.lit(run_date), F.lit(OPEN_DATE), F.lit(DELETED_FLAG))),
    )
    # one open version per key is the invariant this function keeps; input
    # that breaks it stops the job instead of losing the extra versions
    invariant = F.assert_true(F.col("n_open") <= 1,
                              F.concat(F.lit(f"{spec.name}: several open versions of key "),
                                       F.col(key).cast("string")))
    out = (g.select(key, change.alias("change"), F.explode(rows).alias("v"), "n_open")
           .where(F.col("v").isNotNull() & invariant.isNull()))
    return out.select(key, *[F.col(f"v.{a}").alias(a) for a in attrs],
                      "v.effective_from", "v.effective_to", "v.deleted_flg", "change")


def scd2_apply(hist: DataFrame, stage: DataFrame, spec: DimSpec, run_date: _dt.date,
               keys: DataFrame | None = None, missing_snapshot: str = "skip",
               null_update: str = "coalesce") -> DataFrame:
    """The full history after the day = untouched closed rows ∪ the
    rewritten open slice.

    ``keys=None`` means no snapshot arrived: with ``missing_snapshot='skip'``
    nothing is deleted; ``'delete'`` treats it as empty (every live key is
    tombstoned), which is what the source system does. An empty but present
    snapshot always deletes.
    """
    closed = hist.where(~is_open() | F.col("effective_to").isNull()).select(*spec.history_columns)
    touched = scd2_touched(hist, stage, spec, run_date, keys, missing_snapshot, null_update)
    return closed.unionByName(touched.drop("change"))


def quarantine_keys(stage: DataFrame, spec: DimSpec) -> DataFrame:
    """Stage rows that cannot be versioned: NULL key."""
    return stage.where(F.col(spec.key).isNull())


__all__ = [
    "scd2_new", "scd2_changed", "scd2_resurrected", "scd2_closed", "scd2_tombstones",
    "scd2_close_deleted", "scd2_touched", "scd2_apply", "quarantine_keys", "duplicate_stage_rows",
]
