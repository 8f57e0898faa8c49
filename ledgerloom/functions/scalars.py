"""Column expressions that keep PostgreSQL semantics on Spark built-ins."""

from __future__ import annotations

import calendar
from datetime import date

from pyspark.sql import Column, functions as F

ColumnLike = Column | str

# PostgreSQL date patterns in use and their Spark spelling.
DATE_PATTERNS = {
    "YYYY": "yyyy",
    "YYYY-MM": "yyyy-MM",
    "YYYYMM": "yyyyMM",
    "YYYYMMDD": "yyyyMMdd",
    "YYMMDD": "yyMMdd",
    "YY": "yy",
    "MM": "MM",
    "MonYYYY": "MMMyyyy",
}


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def concat_skip_null(*parts: ColumnLike) -> Column:
    """Concatenate and skip nulls (Spark ``concat`` would return null)."""
    return F.concat_ws("", *[as_col(p).cast("string") for p in parts])


def part(value: ColumnLike, separator: str, n: int) -> Column:
    return F.split_part(as_col(value), F.lit(separator), F.lit(n))


def head(value: ColumnLike, n: int) -> Column:
    return F.left(as_col(value), F.lit(n))


def tail(value: ColumnLike, n: int) -> Column:
    return F.right(as_col(value), F.lit(n))


def contains(haystack: ColumnLike, needle: ColumnLike) -> Column:
    """``position(needle in haystack) > 0``; an empty needle is found everywhere."""
    return F.position(as_col(needle), as_col(haystack)) > 0


def matches(value: ColumnLike, pattern: str) -> Column:
    """``~``: the pattern may match anywhere; null stays null."""
    return as_col(value).rlike(pattern)


def not_matches(value: ColumnLike, pattern: str) -> Column:
    return ~as_col(value).rlike(pattern)


def blank_to_null(value: ColumnLike) -> Column:
    return F.nullif(as_col(value), F.lit(""))


def date_text(value: ColumnLike, pattern: str) -> Column:
    """``to_char`` for the date patterns in use, with ``MONYYYY`` in capitals."""
    if pattern == "MONYYYY":
        return F.upper(F.date_format(as_col(value), DATE_PATTERNS["MonYYYY"]))
    return F.date_format(as_col(value), DATE_PATTERNS[pattern])


def month_start(value: ColumnLike) -> Column:
    return F.trunc(as_col(value), "month")


def end_of_last_month(value: ColumnLike) -> Column:
    return F.last_day(F.add_months(as_col(value), -1))


def posting_date(order_date: ColumnLike, as_of: date, legacy_month_number: bool = False) -> Column:
    """Posting date of a document seen on ``as_of``.

    Earlier month: first day of the current month; current month: the order date; later: null.
    Months are compared with their year. ``legacy_month_number`` compares bare month numbers.
    """
    day = as_col(order_date).cast("date")
    first = F.lit(as_of.replace(day=1))
    if legacy_month_number:
        order_month, this_month = F.month(day), F.lit(as_of.month)
    else:
        order_month, this_month = F.trunc(day, "month"), first
    return F.when(order_month < this_month, first).when(order_month == this_month, day)


def posting_description(country: ColumnLike, channel: ColumnLike, doc: ColumnLike, stamp: ColumnLike) -> Column:
    return concat_skip_null(
        part(country, "-", 2), F.lit("-"), part(channel, "-", 2),
        F.lit(": Booking revenue, Inv#"), doc, F.lit("_"), date_text(stamp, "YYMMDD"),
    )


def dated_doc(doc: ColumnLike, day: ColumnLike) -> Column:
    return concat_skip_null(doc, F.lit("_"), date_text(day, "YYYYMMDD"))


def unit_price(amount: ColumnLike, quantity: ColumnLike, scale: int = 2) -> Column:
    """Amount per unit, half away from zero; a zero quantity gives null instead of an error."""
    qty = as_col(quantity)
    return F.round(as_col(amount) / F.when(qty != 0, qty), scale)


def positive_gap(estimate: ColumnLike, invoiced: ColumnLike) -> Column:
    """Estimate not yet invoiced, never below zero; a null estimate gives zero."""
    est, inv = as_col(estimate), F.coalesce(as_col(invoiced), F.lit(0))
    return F.when(est > inv, est - inv).otherwise(F.lit(0))


def period_day(period: str, day: int = 25) -> date:
    """``'YYYY-MM'`` and a day, clamped to the month end (so 31 works in every month)."""
    year, month = (int(p) for p in period.split("-"))
    return date(year, month, min(day, calendar.monthrange(year, month)[1]))


def shift_period(period: str, months: int) -> str:
    year, month = (int(p) for p in period.split("-"))
    index = year * 12 + month - 1 + months
    return f"{index // 12:04d}-{index % 12 + 1:02d}"


def in_period(value: ColumnLike, period: str) -> Column:
    """Half-open month range on the raw column, so that the filter reaches the scan."""
    start, end = period_day(period, 1), period_day(shift_period(period, 1), 1)
    return (as_col(value) >= F.lit(start)) & (as_col(value) < F.lit(end))


def in_values(value: ColumnLike, values) -> Column:
    return as_col(value).isin(*values) if values else F.lit(False)
