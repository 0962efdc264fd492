"""Each card's operations in time order, with neighbours attached.

The source system computes ``LEAD``/``LAG`` over
``PARTITION BY passport, fio, phone, card_num ORDER BY trans_date``. Ties on
``trans_date`` make that order non-deterministic, so the order here is made
total with ``trans_id``, the terminal version, the remaining window inputs and
what tells the owner's versions apart (NULLs last, as the source database sorts
them); rows that still tie are equal in every column.

Two forms:

* ``card_sequence`` — the exact lead/lag columns over the whole card
  partition (windows per card and day; only the first and last rows of each day meet across
  days, so no task holds a whole card).
* ``rule_frame`` — what the rules need, split by card *and* day so a hot card
  is spread over many tasks. Rule 3 looks at the next operation only when it
  is at most 1 hour later, rule 4 at the three previous ones only when they
  are at most 20 minutes earlier. So each (card, day) partition only needs a
  halo: the tail of the previous day within the lag reach and the head of the
  next day within the lead reach. Rows are copied into the neighbouring day
  partition when they fall in that halo (a few percent of rows), the window
  runs per (card, day), and only the home copy of each row is kept. Any
  neighbour outside the halo is outside the rule's time limit too, so the
  rule predicates are exactly those of the unsplit window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.schemas import AMOUNT_GUESS_REJECTS

PARTITION = ("passport", "fio", "phone", "card_num")
ORDER = ("trans_date", "trans_id", "te_effective_from", "terminal_city", "amt", "oper_result",
         "oper_type", "passport_valid_to", "ac_valid_to")
DAY_SECONDS = 86_400
NULL_DAY = 2**31 - 1  # bucket of rows without a trans_date: sorts after every real day


def _order(ties: tuple[str, ...] = ()) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in (*ORDER, *ties)]


def card_window(*extra_partition: str):
    return Window.partitionBy(*PARTITION, *extra_partition).orderBy(*_order())


def neighbour_columns(w, lags: int = AMOUNT_GUESS_REJECTS) -> dict[str, Column]:
    cols = {
        "terminal_city_lead": F.lead("terminal_city", 1).over(w),
        "trans_date_lead": F.lead("trans_date", 1).over(w),
    }
    for k in range(lags, 0, -1):
        cols[f"oper_result_lag_{k}"] = F.lag("oper_result", k).over(w)
    for k in range(lags, 0, -1):
        cols[f"amt_lag_{k}"] = F.lag("amt", k).over(w)
    cols[f"trans_date_lag_{lags}"] = F.lag("trans_date", lags).over(w)
    return cols


def _buckets_per_day(bucket_seconds: int) -> int:
    if bucket_seconds <= 0 or DAY_SECONDS % bucket_seconds:
        raise ValueError("bucket_seconds must divide a day")
    return DAY_SECONDS // bucket_seconds


def card_sequence_whole(ctx: DataFrame) -> DataFrame:
    """W0 over the whole card partition (one task per card)."""
    return ctx.withColumns(neighbour_columns(card_window()))


LAG_COLUMNS = ("oper_result", "amt", "trans_date")
LEAD_COLUMNS = ("terminal_city", "trans_date")


def card_sequence(ctx: DataFrame, lags: int = AMOUNT_GUESS_REJECTS,
                  bucket_seconds: int = DAY_SECONDS, ties: tuple[str, ...] = ()) -> DataFrame:
    """The context plus lead(city, date), lag 1–3 of result and amount and
    lag 3 of the date — exact, with a hot card split by day.

    1. Rows are windowed per (owner+card, day): in-day lead/lag, row number.
    2. All neighbours of a row that is neither among the first nor the last ``lags``
       rows of its day lie in that day: it is done.
    3. The other rows (at most 2 * ``lags`` per day) are windowed per owner+card. A
       neighbour that falls outside the day is the next or a previous one among them,
       since those that would stand between are among them too.

    Both kinds of rows read one exchange, so the context is computed and dealt out once. The
    owner's columns travel as the group alone, and what a row saw in its day only where the
    day has rows between the first and the last (else those among them tell it all).

    ``ties``: further columns that put rows in order which are equal in all of ``ORDER``.
    """
    grp = F.struct(*[F.col(c) for c in PARTITION])       # NULL fio stays one group
    per_day = _buckets_per_day(bucket_seconds)
    sec_of_day = F.hour("trans_date") * 3600 + F.minute("trans_date") * 60 + F.second("trans_date")
    day = F.coalesce(F.unix_date(F.to_date("trans_date")).cast("bigint") * per_day
                     + F.floor(sec_of_day / bucket_seconds), F.lit(NULL_DAY).cast("bigint"))
    rows = (ctx.select(*[c for c in ctx.columns if c not in PARTITION], grp.alias("_grp"),
                       day.alias("_day")).repartition("_grp", "_day"))
    w = Window.partitionBy("_grp", "_day").orderBy(*_order(ties))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inner = rows.withColumns({
        "_rn": F.row_number().over(w),
        "_cnt": F.count(F.lit(1)).over(whole),
        **{f"_lead_{c}": F.lead(c, 1).over(w) for c in LEAD_COLUMNS},
        **{f"_lag{k}_{c}": F.lag(c, k).over(w) for c in LAG_COLUMNS for k in range(1, lags + 1)},
    })
    edge = (F.col("_rn") <= lags) | (F.col("_rn") > F.col("_cnt") - lags)
    gaps = F.col("_cnt") > 2 * lags

    def result(df: DataFrame, around) -> DataFrame:
        """The neighbour columns; ``around(column, k)`` is the value k rows back (-1: next)
        of a row whose neighbour is outside its day."""
        cols = {}
        for c in LEAD_COLUMNS:
            own = F.col(f"_lead_{c}")
            cols[f"{c}_lead"] = own if around is None else F.when(
                gaps & (F.col("_rn") < F.col("_cnt")), own).otherwise(around(c, -1))
        for k in range(lags, 0, -1):
            for c in LAG_COLUMNS:
                if c != "trans_date" or k == lags:
                    own = F.col(f"_lag{k}_{c}")
                    cols[f"{c}_lag_{k}"] = own if around is None else F.when(
                        gaps & (F.col("_rn") > k), own).otherwise(around(c, k))
        return df.withColumns(cols).select(
            *[F.col(f"_grp.{c}").alias(c) if c in PARTITION else c for c in ctx.columns],
            *_neighbour_names(lags))

    edges = Window.partitionBy("_grp").orderBy(*_order(ties))
    inside = result(inner.where(~edge), None)
    seen = [c for c in inner.columns if c.startswith(("_lead_", "_lag"))]
    narrow = inner.where(edge).withColumns({c: F.when(gaps, F.col(c)) for c in seen})
    outside = result(narrow, lambda c, k: F.lag(c, k).over(edges))
    return inside.unionByName(outside)


def _neighbour_names(lags: int) -> list[str]:
    back = range(lags, 0, -1)
    return [*[f"{c}_lead" for c in LEAD_COLUMNS],
            *[f"{c}_lag_{k}" for c in ("oper_result", "amt") for k in back],
            f"trans_date_lag_{lags}"]


def reach_seconds(limit: str) -> int:
    """Seconds in a limit such as '1 hour' or '20 minutes'."""
    amount, unit = limit.split()
    unit = unit.lower().rstrip("s")
    return int(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]


WINDOW_INPUTS = (*PARTITION, *[c for c in ORDER if c not in PARTITION], "report_dt")


def collapse_copies(ctx: DataFrame) -> DataFrame:
    """Rows that agree on every window input, as one row with ``copies``.

    A group of identical operations (a batch delivered with repeats) would
    otherwise sit in one window partition; the count is combined map-side,
    so such a group reaches the shuffle as one row per map task."""
    return ctx.groupBy(*WINDOW_INPUTS).agg(F.count(F.lit(1)).alias("copies"))


def rule_frame(ctx: DataFrame, lead_reach: str = "1 hour", lag_reach: str = "20 minutes",
               bucket_seconds: int = DAY_SECONDS) -> DataFrame:
    """Context rows with the neighbours rules 3 and 4 need, computed per
    (card, time bucket) with a halo (see module doc).

    Besides the ``neighbour_columns`` it adds ``lead_city_min`` /
    ``lead_city_max``: over all rows of the same card and the same
    ``trans_date`` whose next operation lies within ``lead_reach``, the
    smallest and largest next city. Rule 3 pairs every operation with every
    row sharing its card and time, so an operation qualifies when its own city
    differs from either bound — no pairs are formed.

    ``ctx`` may carry a ``copies`` column (see ``collapse_copies``): a row
    then stands for that many identical operations in a row. Their next
    operation is the copy itself (same city, no time apart), and
    ``copies_lag_1/2`` let rule 4 see repeats among the previous operations.
    """
    lead_s, lag_s = reach_seconds(lead_reach), reach_seconds(lag_reach)
    # one shuffle: a hot card is split by its buckets
    spread = halo_copies(ctx, lead_s, lag_s, bucket_seconds).repartition("card_num", "bucket")
    return frame_of_buckets(spread, lead_s)


def halo_copies(df: DataFrame, lead_s: int, lag_s: int, bucket_seconds: int) -> DataFrame:
    """``df`` with each row in its ``home_bucket`` of ``trans_date`` and copied into every
    other ``bucket`` whose rows have it within their reach."""
    per_day = _buckets_per_day(bucket_seconds)
    sec_of_day = F.hour("trans_date") * 3600 + F.minute("trans_date") * 60 + F.second("trans_date")
    in_bucket = sec_of_day % bucket_seconds
    home = (F.unix_date(F.to_date("trans_date")).cast("bigint") * per_day
            + F.floor(sec_of_day / bucket_seconds))
    # home bucket, plus the neighbour buckets a row is halo for (NULL when not);
    # a plain explode + null filter stays in generated code (no lambda)
    buckets = F.array(
        F.col("home_bucket"),
        # within the lag reach of a later bucket's start
        *[F.when(in_bucket >= j * bucket_seconds - lag_s, F.col("home_bucket") + j)
          for j in range(1, -(-lag_s // bucket_seconds) + 1)],
        # within the lead reach of an earlier bucket's end
        *[F.when(in_bucket + (j - 1) * bucket_seconds <= lead_s, F.col("home_bucket") - j)
          for j in range(1, lead_s // bucket_seconds + 2)],
    )
    # an operation without a time has no neighbours and no rule can select it
    return (df.where(F.col("trans_date").isNotNull()).withColumn("home_bucket", home)
            .withColumn("bucket", F.explode(buckets))
            .where(F.col("bucket").isNotNull()))


def frame_of_buckets(spread: DataFrame, lead_s: int) -> DataFrame:
    """The neighbours within each (card, ``bucket``) of ``halo_copies``, for the rows at home there."""
    if "copies" not in spread.columns:
        spread = spread.withColumn("copies", F.lit(1))
    w = card_window("bucket")
    framed = spread.withColumns({**neighbour_columns(w),
                                 "copies_lag_1": F.lag("copies", 1).over(w),
                                 "copies_lag_2": F.lag("copies", 2).over(w)})
    ties = Window.partitionBy("card_num", "bucket", "trans_date")
    near_next = F.when(
        (F.col("trans_date_lead") - F.col("trans_date")) <= F.expr(f"INTERVAL '{lead_s}' SECOND"),
        F.col("terminal_city_lead"))
    # a repeated operation is followed by its own copy: its city is a next city too
    own_copy = F.when(F.col("copies") >= 2, F.col("terminal_city"))
    framed = framed.withColumns({
        "lead_city_min": F.min(F.least(near_next, own_copy)).over(ties),
        "lead_city_max": F.max(F.greatest(near_next, own_copy)).over(ties),
    })
    return (framed.where(F.col("bucket") == F.col("home_bucket"))
            .drop("bucket", "home_bucket"))
