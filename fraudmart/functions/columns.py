"""Column expressions shared by the operators.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudmart.schemas import LIVE_FLAG, OPEN_DATE, TXN_TIME_PATTERN


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def differs(left: Iterable[str | Column], right: Iterable[str | Column]) -> Column:
    """True when any attribute pair differs, treating NULL as a value.

    ``a <> b OR (a IS NULL AND b IS NOT NULL) OR (a IS NOT NULL AND b IS NULL)``
    is exactly ``NOT (a <=> b)``; the result is never NULL.
    """
    terms = [~col(a).eqNullSafe(col(b)) for a, b in zip(left, right, strict=True)]
    return reduce(lambda x, y: x | y, terms, F.lit(False))


def is_open(prefix: str = "") -> Column:
    return F.col(f"{prefix}effective_to") == F.lit(OPEN_DATE)


def is_live(prefix: str = "") -> Column:
    return F.col(f"{prefix}deleted_flg") == F.lit(LIVE_FLAG)


def day_before(d: str | Column) -> Column:
    return F.date_sub(col(d), 1)


def within(later: str | Column, earlier: str | Column, limit: str) -> Column:
    """``later - earlier <= limit`` on zone-less timestamps (inclusive)."""
    return (col(later) - col(earlier)) <= F.expr(f"INTERVAL {_interval_literal(limit)}")


def _interval_literal(limit: str) -> str:
    amount, unit = limit.split()
    unit = unit.rstrip("s").upper()
    return f"'{int(amount)}' {unit}"


def full_name(last: str, first: str, patronymic: str) -> Column:
    """``last || ' ' || first || ' ' || patronymic``: any NULL part makes it NULL
    (``concat``, not ``concat_ws`` which would skip NULLs)."""
    return F.concat(F.col(last), F.lit(" "), F.col(first), F.lit(" "), F.col(patronymic))


def parse_amount(c: str | Column) -> Column:
    """Decimal comma or point text → DECIMAL(9,2); unparsable text → NULL."""
    return _try_cast(F.replace(F.trim(col(c)), F.lit(","), F.lit(".")), "decimal(9,2)")


def parse_timestamp(c: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text (a fraction may follow, as typed files have it)
    → zone-less timestamp; anything else, a partial date too → NULL."""
    text = F.trim(col(c))
    return F.when(text.rlike(TXN_TIME_PATTERN), _try_cast(text, "timestamp_ntz"))


def parse_date(c: str | Column) -> Column:
    return _try_cast(F.trim(col(c)), "date")


def _try_cast(c: Column, to: str) -> Column:
    return c.try_cast(to)


def clean_key(c: str | Column) -> Column:
    """Trim the blank padding fixed-width CHAR columns carry."""
    return F.rtrim(col(c))


def ntz_lit(value) -> Column:
    """A zone-less timestamp literal. ``F.lit(datetime)`` would be a
    session-zoned TIMESTAMP and compare against TIMESTAMP_NTZ columns through
    the session time zone; text → TIMESTAMP_NTZ involves no zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def round_to_second(c: str | Column) -> Column:
    """TIMESTAMP(0) semantics: round half up to the nearest whole second."""
    s = col(c) + F.expr("INTERVAL '0.5' SECOND")
    # make_timestamp_ntz with whole seconds truncates; no time zone is involved.
    return F.make_timestamp_ntz(F.year(s), F.month(s), F.dayofmonth(s), F.hour(s), F.minute(s),
                                F.second(s))


def all_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda x, y: x & y, conds)
