"""Shared measures and scalar helpers.

Each helper fixes one semantic decision centrally, so no report re-decides it:

* item value is ``price + freight_value`` in decimal (exact sums);
* day differences count midnights crossed (two-argument ``datediff``), the
  meaning of ``DATEDIFF(day, a, b)``;
* month labels are ``yyyy-MM`` (year-month, not year-minute);
* year filters are half-open timestamp ranges, which Parquet can prune on,
  instead of ``year(ts) = y``;
* averages of money are exact decimal sums divided in double, rounded money
  ratios use integer cents with half-up rounding;
* integer averages (of day counts) truncate toward zero, like an integer
  ``AVG``; every report with one has the switch ``integer_avg``;
* with ``exact=True`` money ratios are decimals, divided in two limbs without
  any double.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def item_value(price: str = "price", freight: str = "freight_value") -> Column:
    """Value of an item row: price plus freight (decimal)."""
    return F.col(price) + F.col(freight)


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Number of day boundaries between ``start`` and ``end`` (end - start)."""
    return F.datediff(col(end), col(start))


def month_label(ts: str | Column) -> Column:
    """Year-month label ``yyyy-MM`` of a timestamp."""
    return F.date_format(col(ts), "yyyy-MM")


def _ntz(y: int) -> Column:
    return F.lit(_dt.datetime(y, 1, 1).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def in_year(ts: str | Column, year: int) -> Column:
    """``year(ts) = year`` as a range predicate the scan can push down."""
    c = col(ts)
    return (c >= _ntz(year)) & (c < _ntz(year + 1))


def in_years(ts: str | Column, years: Iterable[int]) -> Column:
    """Timestamp falls in any of ``years`` (OR of half-open ranges)."""
    cond = None
    for y in sorted(set(years)):
        p = in_year(ts, y)
        cond = p if cond is None else cond | p
    return cond if cond is not None else F.lit(False)


def to_double(c: str | Column) -> Column:
    """Cast to double (final presentation of money)."""
    return col(c).cast("double")


def exact_avg(c: str | Column) -> Column:
    """Average as exact sum / count.  For decimals the sum is exact and the
    division is one correctly rounded double operation, so the result does not
    depend on summation order."""
    return F.sum(col(c)).cast("double") / F.count(col(c))


def trunc_avg(c: str | Column) -> Column:
    """Integer average truncated toward zero (NULL for an empty group)."""
    return F.avg(col(c)).cast("int")


def int_avg(c: str | Column, integer_avg: bool) -> Column:
    """Average of integers: truncated toward zero (``integer_avg``) or an
    exact sum divided by the count."""
    return trunc_avg(c) if integer_avg else exact_avg(c)


def decimal_ratio(total: Column, n: Column, precision: int, scale: int = 2) -> Column:
    """``cast(total / n as decimal(precision, scale))`` rounded half away from
    zero, exactly; NULL for ``n = 0``; an error where it does not fit.

    ``total`` is a decimal with at most ``scale`` digits and less than 9 * 10^36
    of its smallest units, ``n`` a positive integer.  The units are divided in
    two limbs of 18 digits, the first remainder carried into the second limb,
    so no intermediate needs more than 38 digits."""
    limb = F.lit(Decimal(10 ** 18))
    count = F.nullif(n.cast("long"), F.lit(0).cast("long"))
    units = (F.abs(total).cast(f"decimal({38 - scale},{scale})") * F.lit(10 ** scale)).cast("decimal(38,0)")
    div = lambda a, b: F.call_function("div", a, b)
    low = units % limb
    high = div(units, limb)
    first = div(high, count)
    rest = (high - first * count).cast("decimal(19,0)") * limb + low
    second = div(rest.cast("decimal(38,0)"), count.cast("decimal(19,0)"))
    left = rest - second.cast("decimal(19,0)") * count.cast("decimal(19,0)")
    up = F.when(left * 2 >= count.cast("decimal(19,0)"), F.lit(1)).otherwise(F.lit(0))
    whole = (first.cast("decimal(19,0)") * limb).cast("decimal(38,0)") + second.cast("decimal(19,0)") + up
    sized = (whole.cast("decimal(38,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal({precision},{scale})")
    return F.when(total < 0, -sized).otherwise(sized).cast(f"decimal({precision},{scale})")


def round_half_up_ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """``round(numerator / denominator, scale)`` half-up, computed in integers:
    ``(2 * num * 10^scale + den) div (2 * den)``.  Both inputs are exact
    (decimal with at most two digits, or integer); the result is a double
    with ``scale`` decimals.  Valid for non-negative values."""
    unit = 10 ** scale
    num = (numerator * unit).cast("decimal(38,0)")
    twice = num * 2 + denominator
    den = (denominator * 2).cast("decimal(38,0)")
    # floor division made exact: subtract the remainder, then divide.
    q = (twice - F.pmod(twice, den)) / den
    return q.cast("long").cast("double") / unit


def money_ratio(total: Column, n: Column) -> Column:
    """``cast(total / n as decimal(p,2))`` for positive money totals."""
    return round_half_up_ratio(total, n, 2)
