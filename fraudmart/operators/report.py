"""Append the day's fraud events to the accumulating report.

The report is keyed for dedupe on ``(passport, report_dt, event_dt)`` —
*not* the event type (as in the source system; ``include_type=True`` adds
it). Because ``report_dt`` is the run date in every new row, only the
``report_dt = run_date`` partition of the report can match: the existing side
is filtered to it, which prunes to one partition when the report is stored
partitioned by ``report_dt``.

``event_dt`` is stored as TIMESTAMP(0): it is rounded to the second *before*
the comparison, so a same-day re-run finds the rows it wrote.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.functions.columns import ntz_lit, round_to_second
from fraudmart.operators.spread import by_key

REPORT_COLUMNS = ("event_dt", "passport", "fio", "phone", "event_type", "report_dt")


def report_rows(events: DataFrame) -> DataFrame:
    return events.select(round_to_second("event_dt").alias("event_dt"), "passport", "fio",
                         "phone", F.col("event_type").cast("string").alias("event_type"),
                         "report_dt")


def append_report(events: DataFrame, report: DataFrame, run_date: _dt.date,
                  include_type: bool = False) -> DataFrame:
    """Rows of ``events`` to append: those whose key is not in today's
    partition yet. A NULL passport never matches, so such rows are appended
    on every run (source system behaviour)."""
    keys = ["passport", "report_dt", "event_dt"] + (["event_type"] if include_type else [])
    existing = report.where(F.col("report_dt") == F.lit(run_date)).select(*keys)
    return report_rows(events).join(by_key(existing), keys, "left_anti")


def events_since(events: DataFrame, since: _dt.datetime | _dt.date) -> DataFrame:
    """Keep only events at or after ``since`` (see also ``fraud_events(since=)``,
    which also narrows what is read)."""
    if not isinstance(since, _dt.datetime):
        since = _dt.datetime.combine(since, _dt.time())
    return events.where(F.col("event_dt") >= ntz_lit(since))
