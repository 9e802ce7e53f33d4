"""Dates and integer periods since 1970-01-01.

Resolutions: "32" calendar months, "16", "8" and "1" blocks of days that begin anew each 1 January. All column
functions are arithmetic over built-in date functions, so they stay in generated code and push down.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PER_YEAR = {"32": 12, "16": 23, "8": 46, "1": 365}


def _c(x) -> Column:
    return x if isinstance(x, Column) else (F.col(x) if isinstance(x, str) else F.lit(x))


def per_year(res: str) -> int:
    """Periods in a year; an unknown resolution raises."""
    if res not in PER_YEAR:
        raise ValueError(f"unknown temporal resolution {res!r}")
    return PER_YEAR[res]


def period(date, res: str) -> Column:
    """The period that holds ``date``. At "1" a leap year's 31 December shares the next 1 January's period."""
    d, n = _c(date).cast("date"), per_year(res)
    years = F.year(d) - 1970
    return (years * 12 + F.month(d) - 1 if res == "32" else years * n + F.floor((F.dayofyear(d) - 1) / int(res))).cast("int")


def period_start(p, res: str) -> Column:
    """The first date of a period."""
    n, p = per_year(res), _c(p).cast("int")
    year, at = F.floor(p / n).cast("int") + 1970, F.pmod(p, F.lit(n))
    if res == "32":
        return F.make_date(year, at + 1, F.lit(1))
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (at * int(res)).cast("int"))


def period_of(date: str, res: str) -> int:
    """``period`` for a literal date, on the driver."""
    d, n = dt.date.fromisoformat(date[:10]), per_year(res)
    if res == "32":
        return (d.year - 1970) * 12 + d.month - 1
    return (d.year - 1970) * n + (d.timetuple().tm_yday - 1) // int(res)


def start_of(p: int, res: str) -> dt.date:
    """``period_start`` on the driver."""
    n = per_year(res)
    year, at = 1970 + p // n, p % n
    return dt.date(year, at + 1, 1) if res == "32" else dt.date(year, 1, 1) + dt.timedelta(days=at * int(res))


def beginning(date, res: str) -> Column:
    """``date`` moved back to the start of its period."""
    return period_start(period(date, res), res)


def period_span(p, res: str) -> Column:
    """Days in a period; the last of a year is shorter."""
    return F.datediff(period_start(_c(p) + 1, res), period_start(p, res))


def date_offset(from_res: str, p, to_res: str, q) -> Column:
    """Days from the start of ``p`` to the start of ``q``."""
    return F.datediff(period_start(q, to_res), period_start(p, from_res))


def shift_resolution(p, from_res: str, to_res: str) -> Column:
    """The period at ``to_res`` that holds the first day of ``p``."""
    return period(period_start(p, from_res), to_res)


def relative_period(res: str, start, date) -> Column:
    return period(date, res) - _c(start)


def diff_in_days(a, b) -> Column:
    """Days from ``a`` to ``b``; dates in reverse order raise."""
    n = F.datediff(_c(b), _c(a))
    return F.when(n < 0, F.raise_error(F.lit("dates are reversed")).cast("int")).otherwise(n)


def within_dates(start: str, end: str, date) -> Column:
    """start <= date < end."""
    d = _c(date).cast("date")
    return (d >= F.to_date(F.lit(start))) & (d < F.to_date(F.lit(end)))


def ordinal(date) -> Column:
    """Days since 1 January."""
    return F.dayofyear(_c(date).cast("date")) - 1


def convert(text, from_format: str, to_format: str) -> Column:
    return F.date_format(F.to_date(_c(text), from_format), to_format)


def inc_date(date, days) -> Column:
    return F.date_add(_c(date).cast("date"), _c(days).cast("int"))


def date_millis(date) -> Column:
    """Milliseconds of a date's midnight, UTC."""
    return F.datediff(_c(date).cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000


def monthly_millis(start, end) -> Column:
    """Milliseconds of each month's start from ``start`` to ``end``, both included."""
    return F.transform(F.sequence(F.trunc(_c(start).cast("date"), "month"), F.trunc(_c(end).cast("date"), "month"), F.expr("interval 1 month")), date_millis)


def date_index(res: str, start, size, date) -> Column:
    """Where ``date`` lies in a series of ``size`` values from ``start`` on; null outside."""
    at = period(date, res) - _c(start)
    return F.when((at >= 0) & (at < _c(size)), at)


def value_at(res: str, start, series, date, default=None, clamp: bool = False) -> Column:
    """The value at ``date``; outside the series ``default``, or with ``clamp`` the nearest value."""
    s = _c(series)
    at = period(date, res) - _c(start)
    if clamp:
        at = F.greatest(F.lit(0), F.least(at, F.size(s) - 1))
    found = F.when((at >= 0) & (at < F.size(s)), F.try_element_at(s, at + 1))
    return F.when((at >= 0) & (at < F.size(s)), found).otherwise(F.lit(default))


def key_span(res: str, start, end) -> Column:
    """The first dates of all periods from ``start`` to ``end`` (dates), both included."""
    return F.transform(F.sequence(period(start, res), period(end, res)), lambda p: period_start(p, res))


def consecutive(periods) -> Column:
    """True if the array, sorted, has gaps of one only."""
    p = F.array_sort(_c(periods))
    return F.array_max(p) - F.array_min(p) + 1 == F.size(F.array_distinct(p))


def series_to_map(start, series) -> Column:
    s = _c(series)
    return F.map_from_arrays(F.when(F.size(s) > 0, F.sequence(_c(start), _c(start) + F.size(s) - 1)).otherwise(F.array().cast("array<int>")), s)


def map_to_series(periods, fill) -> Column:
    """The values of a map by period from the least to the greatest, holes filled."""
    from .arrays import let

    def dense(m: Column) -> Column:
        keys = F.map_keys(m)
        return F.transform(F.sequence(F.array_min(keys), F.array_max(keys)), lambda p: F.coalesce(F.try_element_at(m, p), F.lit(fill)))

    return let(_c(periods), dense)


def map_start(periods) -> Column:
    return F.array_min(F.map_keys(_c(periods)))


def sorted_dates(dates) -> Column:
    return F.array_sort(_c(dates)) == _c(dates)


def intervals_overlap(s1, e1, s2, e2) -> Column:
    """Closed intervals that share a point; an interval that ends before it starts raises."""
    s1, e1, s2, e2 = map(_c, (s1, e1, s2, e2))
    return F.when((s1 > e1) | (s2 > e2), F.raise_error(F.lit("interval ends before it starts")).cast("boolean")).otherwise((s1 <= e2) & (s2 <= e1))


def temporal_subvec(start, series, get_start, get_end) -> Column:
    """Values of a series from period ``get_start`` up to, not including, ``get_end``."""
    s, at = _c(series), _c(start)
    lo, hi = F.greatest(_c(get_start), at), F.least(_c(get_end), at + F.size(s))
    return F.slice(s, lo - at + 1, F.greatest(hi - lo, F.lit(0)))
