"""Joins with heavy hitters: a hot key's facts dealt over many tasks.

A shuffle join sends all rows of a key to one task. Where a key holds a share of
the rows that does not shrink with the cluster (a third of all operations on one
card), more machines do not help. ``hot_keys`` finds such keys with a frequency
sketch (``approx_top_k``, one small buffer per map task); ``spread_join`` deals
their facts over ``parts`` salts and copies the other side's few rows of those
keys once per salt. All other keys join as before, with salt 0. Nothing depends on
the planner's run-time skew handling or on a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a key with this share of the rows is hot
SHARE = 0.01
#: tasks that share a hot key
PARTS = 128


@dataclass(frozen=True)
class Hot:
    """Values of ``column`` to spread, at most ``1 / share`` of them."""

    column: str
    values: tuple
    parts: int = PARTS

    def holds(self) -> Column:
        return F.col(self.column).isin(*self.values) if self.values else F.lit(False)


def hot_keys(rows: DataFrame, column: str, share: float = SHARE, parts: int = PARTS) -> Hot:
    """The values of ``column`` that hold ``share`` of the rows or more. Runs one job over
    that column; at most ``1 / share`` values come back. The sketch never misses one: it
    tracks eight times as many items as can be hot, and its counts are upper bounds."""
    most = max(1, int(1 / share))
    tracked = 8 * most
    found = rows.where(F.col(column).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({column}, {most}, {tracked})").alias("top"))
    row = found.first()
    keys = [t["item"] for t in row["top"] or [] if t["count"] >= share * row["n"]]
    return Hot(column, tuple(keys), parts)


def by_key(other: DataFrame) -> DataFrame:
    """``other`` as one side of a join by key in which both sides grow with the data: both are
    dealt out by the key. The planner's own choice goes by the size of compressed files, of
    which 10 MB are 100 to 200 MB of rows that it would send through the driver."""
    return other.hint("merge")


def spread_join(facts: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner",
                hot: Hot | None = None) -> DataFrame:
    """``facts.join(other, on, how)`` with the facts of hot keys dealt over ``hot.parts``
    tasks. ``how``: 'inner' or 'left'."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if hot is None or not hot.values:
        return facts.join(by_key(other), list(on), how)
    if hot.column not in on:
        raise ValueError(f"{hot.column} is no column of the join")
    # the row's number in its task, so that exact copies of one row are dealt out too; any
    # salt is right, as the other side has each of them
    salt = F.when(hot.holds(), F.pmod(F.monotonically_increasing_id(), F.lit(hot.parts)))
    dealt = facts.withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("int"))
    salts = F.when(hot.holds(), F.sequence(F.lit(0), F.lit(hot.parts - 1))).otherwise(
        F.array(F.lit(0)))
    copied = other.withColumn("_salt", F.explode(salts))
    return dealt.join(by_key(copied), [*on, "_salt"], how).drop("_salt")
