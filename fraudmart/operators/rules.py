"""The four fraud rules and their union.

Each rule emits ``(event_dt, passport, fio, phone, event_type, report_dt)``.
``fraud_events`` evaluates rules 1, 2 and 4 as boolean columns of one pass
over the card frame (``explode`` of the matching event types) and adds rule 3,
which is an aggregate per client.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.functions.columns import all_of, ntz_lit, within
from fraudmart.operators.sequence import DAY_SECONDS, collapse_copies, reach_seconds, rule_frame
from fraudmart.operators.spread import by_key
from fraudmart.schemas import (
    AMOUNT_GUESS_LIMIT, DEPOSIT, EVENT_AMOUNT_GUESS, EVENT_CONTRACT, EVENT_PASSPORT,
    EVENT_TWO_CITIES, REJECT, SUCCESS, TWO_CITIES_LIMIT,
)

EVENT_COLUMNS = ("event_dt", "passport", "fio", "phone", "event_type", "report_dt")


def _trans_day() -> Column:
    return F.to_date("trans_date")


def blacklist_first_entry(blacklist: DataFrame) -> DataFrame:
    """Earliest entry date per passport.

    ``passport IN (SELECT passport_num ... WHERE entry_dt <= d)`` holds exactly
    when the earliest entry of that passport is on or before ``d``; the
    pre-aggregation makes the lookup one row per passport (partial aggregation
    map-side, so duplicate entries never reach the shuffle)."""
    return (blacklist.where(F.col("passport_num").isNotNull() & F.col("entry_dt").isNotNull())
            .groupBy("passport_num").agg(F.min("entry_dt").alias("first_entry")))


def with_blacklist(ctx: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Adds ``first_entry``; one row per passport, so no row is repeated."""
    first = blacklist_first_entry(blacklist)
    return (ctx.join(by_key(first), ctx.passport == first.passport_num, "left")
            .drop("passport_num"))


def passport_condition() -> Column:
    """Rule 1: passport expired before the operation day, or blacklisted on or
    before it. NULL expiry never expires."""
    d = _trans_day()
    return (d > F.col("passport_valid_to")) | (F.col("first_entry") <= d)


def contract_condition() -> Column:
    """Rule 2: account contract ended before the operation day."""
    return _trans_day() > F.col("ac_valid_to")


def amount_guess_condition(limit: str = AMOUNT_GUESS_LIMIT) -> Column:
    """Rule 4: three rejects then a success, amounts strictly falling, first
    to last within ``limit`` (inclusive). On a frame of collapsed copies the
    two previous operations must be single: a repeat would make two of the
    lagged amounts equal."""
    single = [F.coalesce(F.col(c), F.lit(1)) == 1 for c in ("copies_lag_1", "copies_lag_2")]
    return all_of([
        *single,
        F.col("oper_result_lag_3") == REJECT,
        F.col("oper_result_lag_2") == REJECT,
        F.col("oper_result_lag_1") == REJECT,
        F.col("oper_result") == SUCCESS,
        F.col("amt_lag_3") > F.col("amt_lag_2"),
        F.col("amt_lag_2") > F.col("amt_lag_1"),
        F.col("amt_lag_1") > F.col("amt"),
        within("trans_date", "trans_date_lag_3", limit),
    ])


def two_cities_condition() -> Column:
    """Rule 3, per operation: not a deposit, and some operation at the same
    card and time is followed within the limit by one in another city."""
    city = F.col("terminal_city")
    return ((F.col("oper_type") != DEPOSIT)
            & ((city != F.col("lead_city_min")) | (city != F.col("lead_city_max"))))


def _events(df: DataFrame, event_type: str) -> DataFrame:
    return df.select(F.col("trans_date").alias("event_dt"), "passport", "fio", "phone",
                     F.lit(event_type).alias("event_type"), "report_dt")


def rule_passport(ctx: DataFrame, blacklist: DataFrame) -> DataFrame:
    return _events(with_blacklist(ctx, blacklist).where(passport_condition()), EVENT_PASSPORT)


def rule_contract_expired(ctx: DataFrame) -> DataFrame:
    return _events(ctx.where(contract_condition()), EVENT_CONTRACT)


def two_cities_events(frame: DataFrame) -> DataFrame:
    """Rule 3 on a ``rule_frame``: the latest qualifying operation per
    (passport, fio, phone); NULL fio is a group of its own."""
    return (frame.where(two_cities_condition())
            .groupBy("passport", "fio", "phone")
            .agg(F.max("trans_date").alias("event_dt"), F.max("report_dt").alias("report_dt"))
            .select("event_dt", "passport", "fio", "phone",
                    F.lit(EVENT_TWO_CITIES).alias("event_type"), "report_dt"))


def rule_two_cities(ctx: DataFrame, within_limit: str = TWO_CITIES_LIMIT,
                    bucket_seconds: int = DAY_SECONDS) -> DataFrame:
    return two_cities_events(rule_frame(ctx, lead_reach=within_limit, bucket_seconds=bucket_seconds))


def rule_amount_guessing(ctx: DataFrame, within_limit: str = AMOUNT_GUESS_LIMIT,
                         bucket_seconds: int = DAY_SECONDS) -> DataFrame:
    frame = rule_frame(ctx, lag_reach=within_limit, bucket_seconds=bucket_seconds)
    return _events(frame.where(amount_guess_condition(within_limit)), EVENT_AMOUNT_GUESS)


def fraud_events(ctx: DataFrame, blacklist: DataFrame,
                 two_cities_limit: str = TWO_CITIES_LIMIT,
                 amount_guess_limit: str = AMOUNT_GUESS_LIMIT,
                 copies: str = "keep", since: _dt.datetime | None = None,
                 bucket_seconds: int = DAY_SECONDS) -> DataFrame:
    """All four rules, bag union (an operation can raise several types).

    One frame and one bitmask of verdicts per operation (rule 3 marks a
    candidate). The few operations with a verdict are dealt out once, by owner
    and day; both consumers — the per-operation explode and the rule-3
    aggregate — read that exchange, so all below it, windows included, runs once.

    ``copies='collapse'`` is for input where one operation may be repeated
    very many times: rules 1 and 2 (one event per operation, repeats
    included) are read from the context directly, rules 3 and 4 from a frame
    over collapsed copies. It costs a second pass over the context, so it is
    not the default; a caller with a long context writes it out first.

    ``bucket_seconds`` (a divisor of the day) sets how finely a hot card is split.

    ``since``: only events at or after that time — exactly the full result
    filtered on ``event_dt``, but reading operations from ``since`` minus the
    rule-4 reach only (a lagged operation further back is outside the time
    limit anyway; rule 3 looks forward). The filter reaches the fact scan, so
    a daily report reads the recent days instead of all history."""
    if since is not None:
        since = _dt.datetime.combine(since, _dt.time()) if not isinstance(since, _dt.datetime) \
            else since
        start = since - _dt.timedelta(seconds=reach_seconds(amount_guess_limit))
        events = fraud_events(ctx.where(F.col("trans_date") >= ntz_lit(start)), blacklist,
                              two_cities_limit, amount_guess_limit, copies,
                              bucket_seconds=bucket_seconds)
        return events.where(F.col("event_dt") >= ntz_lit(since))
    if copies == "collapse":
        return _fraud_events_collapsed(ctx, blacklist, two_cities_limit, amount_guess_limit,
                                       bucket_seconds)
    frame = rule_frame(ctx, lead_reach=two_cities_limit, lag_reach=amount_guess_limit,
                       bucket_seconds=bucket_seconds)
    return events_of_frame(frame, blacklist, amount_guess_limit)


def events_of_frame(frame: DataFrame, blacklist: DataFrame,
                    amount_guess_limit: str = AMOUNT_GUESS_LIMIT) -> DataFrame:
    """The four rules on a ``rule_frame`` (see ``fraud_events``)."""
    def bit(cond, value):
        return F.when(cond, F.lit(value)).otherwise(F.lit(0))

    # one int column carries all four verdicts of an operation; three of them before the rows
    # are dealt out by passport, so that their inputs stay behind
    flags = (bit(contract_condition(), 2) + bit(amount_guess_condition(amount_guess_limit), 4)
             + bit(two_cities_condition(), 8))
    event = ("trans_date", "passport", "fio", "phone", "report_dt")
    judged = frame.select(*event, "passport_valid_to", flags.alias("others"))
    flagged = with_blacklist(judged, blacklist)
    typed = (flagged.select(*event, (F.col("others") + bit(passport_condition(), 1)).alias("flags"))
             .where(F.col("flags") != 0)
             .repartition("passport", "fio", "phone", _trans_day()))

    def has(value):
        return F.col("flags").bitwiseAND(value) != 0

    types = F.array(F.when(has(1), F.lit(EVENT_PASSPORT)), F.when(has(2), F.lit(EVENT_CONTRACT)),
                    F.when(has(4), F.lit(EVENT_AMOUNT_GUESS)))
    per_operation = (typed.select(F.col("trans_date").alias("event_dt"), "passport", "fio",
                                  "phone", F.explode(types).alias("event_type"), "report_dt")
                     .where(F.col("event_type").isNotNull()))
    # no filter on the way: it would move below the exchange and make it another one
    two_cities = (typed.groupBy("passport", "fio", "phone")
                  .agg(F.max(F.when(has(8), F.col("trans_date"))).alias("event_dt"),
                       F.max("report_dt").alias("report_dt"))
                  .where(F.col("event_dt").isNotNull())
                  .select("event_dt", "passport", "fio", "phone",
                          F.lit(EVENT_TWO_CITIES).alias("event_type"), "report_dt"))
    return per_operation.unionByName(two_cities)


def _fraud_events_collapsed(ctx, blacklist, two_cities_limit, amount_guess_limit,
                            bucket_seconds) -> DataFrame:
    flagged = with_blacklist(ctx, blacklist)
    types = F.array(F.when(passport_condition(), F.lit(EVENT_PASSPORT)),
                    F.when(contract_condition(), F.lit(EVENT_CONTRACT)))
    per_operation = (flagged.select(F.col("trans_date").alias("event_dt"), "passport", "fio",
                                    "phone", F.explode(types).alias("event_type"), "report_dt")
                     .where(F.col("event_type").isNotNull()))
    frame = rule_frame(collapse_copies(ctx), lead_reach=two_cities_limit,
                       lag_reach=amount_guess_limit, bucket_seconds=bucket_seconds)
    # a collapsed row raises rule 4 at most once: only its first copy has
    # the three previous operations behind it
    guess = _events(frame.where(amount_guess_condition(amount_guess_limit)), EVENT_AMOUNT_GUESS)
    return per_operation.unionByName(two_cities_events(frame)).unionByName(guess)
