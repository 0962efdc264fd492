"""W0 kept up day by day: the exact lead/lag columns without reading history.

State is the sequence so far (``steps``: rows of ``card_sequence`` with a row name and
the batch that wrote their present form) and a ``tail``: the last three rows of each
owner's card. Operations that come after everything their card has need the tail
only: it holds all rows that they look back on, and of its rows only the last one
changes (its next operation is known now). A card that gets an operation at or before
its last one is *late*: its rows are read again in full and its sequence is made anew;
rows whose neighbours changed are written in their new form. So an ordinary day reads
the day and the tail, and history is looked at only for cards with late operations.

``advance`` returns what to append, which earlier forms it replaces, and the new tail;
``current`` puts appended parts together. Nothing is updated in place. The batch's
sequence is worked out once and written under ``spark.checkpoint.dir``; all three are
read from there. The whole tail goes through it: rows of cards without operations come
out as they were, which spares two joins with the batch's cards. The tail has
three rows a card; its window keeps the last three per map task, so a card with a
third of a day's operations is no hot task there. Rows that are equal in all that the
sequence orders by stay in order of their names, from batch to batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.operators.sequence import LEAD_COLUMNS, ORDER, PARTITION, card_sequence
from fraudmart.operators.spread import by_key
from fraudmart.plans.sizing import scratch
from fraudmart.schemas import AMOUNT_GUESS_REJECTS

LEADS = tuple(f"{c}_lead" for c in LEAD_COLUMNS)
LAGS = tuple(f"{c}_lag_{k}" for c in ("oper_result", "amt")
             for k in range(AMOUNT_GUESS_REJECTS, 0, -1)) + (f"trans_date_lag_{AMOUNT_GUESS_REJECTS}",)
NAME = ("row_name", "version")
TIES = NAME[:1]


@dataclass
class Advance:
    """Rows to append to ``steps``, the (row_name, version) that they replace, the new tail."""

    rows: DataFrame
    replaced: DataFrame
    tail: DataFrame


def named(new: DataFrame, batch: int) -> DataFrame:
    """A batch's context rows with a name each. Write the result: names are given once."""
    return new.withColumns({
        "row_name": F.concat(F.lit(f"{batch}-"), F.monotonically_increasing_id().cast("string")),
        "version": F.lit(batch).cast("long")})


def _card() -> Column:
    return F.struct(*[F.col(c) for c in PARTITION])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _of(rows: DataFrame, cards: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of some cards (``left_anti``: of all others; NULLs are values here)."""
    c = cards.select(F.col("card").alias("_card"))
    return rows.join(by_key(c), _card().eqNullSafe(F.col("_card")), how)


def late_cards(tail: DataFrame, new: DataFrame) -> DataFrame:
    """``card`` of those that get an operation of the batch at or before their last one (a row
    without a time comes last, so a card that has one gets only late operations)."""
    at, none = F.col("trans_date"), F.lit(None)
    both = new.select(_card().alias("card"), at.alias("new"), F.lit(True).alias("comes"),
                      none.cast(tail.schema["trans_date"].dataType).alias("old"),
                      none.cast("boolean").alias("open")).unionByName(
        tail.select(_card().alias("card"), none.cast(new.schema["trans_date"].dataType).alias("new"),
                    none.cast("boolean").alias("comes"), at.alias("old"), at.isNull().alias("open")))
    ends = both.groupBy("card").agg(F.min("new").alias("first"), F.max("old").alias("last"),
                                    F.max("comes").alias("comes"), F.max("open").alias("open"))
    return ends.where(F.col("comes") & (F.col("open") | (F.col("first") <= F.col("last")))).select("card")


def advance(steps: DataFrame, tail: DataFrame, new: DataFrame, batch: int,
            replaced: DataFrame | None = None) -> Advance:
    """The state's change by a batch of ``named`` context rows. ``steps`` (as ``current`` gives
    it; with ``replaced`` all appended rows, of which only the late cards' are then put
    together) is read only where the batch has late cards; one small job finds out."""
    ctx = [c for c in new.columns if c not in NAME]
    late = _written(late_cards(tail, new), "steps-late")
    was = F.struct("version", *LEADS, *LAGS)
    before = tail.withColumn("_whole", F.lit(False))
    if not late.isEmpty():
        history = _of(steps, late)
        history = history if replaced is None else current(history, replaced)
        before = _of(before, late, "left_anti").unionByName(history.withColumn("_whole", F.lit(True)))
    old = before.select(*ctx, "row_name", was.alias("_was"), "_whole")
    rows = old.unionByName(new.select(*ctx, "row_name"), allowMissingColumns=True)
    seen = card_sequence(rows, ties=TIES)
    # a tail's rows do not show all that is before them: they keep what they knew of it
    keeps = F.col("_was").isNotNull() & ~F.coalesce(F.col("_whole"), F.lit(False))
    seen = seen.withColumns({c: F.when(keeps, F.col(f"_was.{c}")).otherwise(F.col(c)) for c in LAGS})
    same = F.struct(*LEADS, *LAGS).eqNullSafe(F.struct(*[F.col(f"_was.{c}") for c in (*LEADS, *LAGS)]))
    changed = F.col("_was").isNull() | ~same
    version = F.when(changed, F.lit(batch).cast("long")).otherwise(F.col("_was.version"))
    out = [*ctx, *LEADS, *LAGS, *NAME]
    seen = _written(seen.select(*out[:-1], version.alias("version"), changed.alias("_changed"),
                                F.col("_was.version").alias("_old")), "steps-seen")
    fresh = seen.where("_changed").select(*out)
    superseded = seen.where(F.col("_changed") & F.col("_old").isNotNull()).select(
        "row_name", F.col("_old").alias("version"))
    newest = Window.partitionBy(*PARTITION).orderBy(
        *[F.col(c).desc_nulls_first() for c in (*ORDER, *TIES)])
    ends = (seen.select(*out).withColumn("_n", F.row_number().over(newest))
            .where(F.col("_n") <= AMOUNT_GUESS_REJECTS).drop("_n"))
    return Advance(fresh, superseded, ends)


def current(rows: DataFrame, replaced: DataFrame) -> DataFrame:
    """The sequence from all appended rows and all replaced forms."""
    return rows.join(by_key(replaced), list(NAME), "left_anti")
