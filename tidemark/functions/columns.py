"""Column expressions shared by the operators.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
Divisions are guarded so ANSI mode never raises on a zero denominator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import GAP_DAYS, SURROGATE_NULL


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def simple_return(current: str | Column, previous: str | Column) -> Column:
    """(current - previous) / previous when previous is known and positive, else NULL."""
    cur, prev = col_(current), col_(previous)
    return F.when(prev.isNotNull() & (prev > 0), (cur - prev) / prev)


def intraday_range(high: str | Column, low: str | Column, close: str | Column) -> Column:
    """(high - low) / close when high and low are known and close is positive."""
    h, lo, c = col_(high), col_(low), col_(close)
    return F.when(h.isNotNull() & lo.isNotNull() & (c > 0), (h - lo) / c)


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """Calendar days from earlier to later; NULL when earlier is unknown."""
    lo = col_(earlier)
    return F.when(lo.isNotNull(), F.datediff(col_(later), lo))


def gap_flag(days: str | Column, limit: int = GAP_DAYS) -> Column:
    """TRUE when more than ``limit`` days passed; an unknown distance is FALSE."""
    return F.coalesce(col_(days) > F.lit(limit), F.lit(False))


def all_zero(*cols: str | Column) -> Column:
    """TRUE when every column is NULL or 0 (a bar with no information)."""
    cond = None
    for c in cols:
        term = F.coalesce(col_(c), F.lit(0.0)) == 0
        cond = term if cond is None else cond & term
    return cond


def surrogate_key(*cols: str | Column) -> Column:
    """Hex md5 over the key columns cast to text, joined by '-', nulls marked."""
    parts = [F.coalesce(col_(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def millis_to_date(ms: str | Column) -> Column:
    """Epoch milliseconds -> UTC calendar date (session time zone is UTC)."""
    return F.to_date(F.timestamp_millis(col_(ms)))


def double_millis_to_date(ms: str | Column) -> Column:
    """Epoch milliseconds held as a double (JSON number) -> UTC date.

    The float is rounded to the nearest integer before the cast, as a
    float-to-integer cast does in the source warehouse.
    """
    return millis_to_date(F.round(col_(ms)).cast("long"))


def zip_shortest(**arrays: str | Column) -> Column:
    """Zip named arrays by position, keeping only positions present in all of
    them; the struct fields carry the given names."""
    cols = {name: col_(a) for name, a in arrays.items()}
    n = F.least(*[F.coalesce(F.size(c), F.lit(0)) for c in cols.values()])
    # arrays_zip alone pads the shorter arrays with NULL; slice to the shortest first.
    return F.arrays_zip(*[F.slice(c, 1, n).alias(name) for name, c in cols.items()])


def pair_value(pair: str | Column, index: int) -> Column:
    """Element ``index`` (0-based) of a [ms, value] pair as a double; NULL when
    absent or not a number (a non-ANSI cast: bad text does not fail the job)."""
    return F.get(col_(pair), index).try_cast("double")


def calendar_columns(day: str | Column) -> dict[str, Column]:
    """Calendar attributes of a date column (Sunday = 1 .. Saturday = 7, ISO week)."""
    d = col_(day)
    dow = F.dayofweek(d)
    return {
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day": F.dayofmonth(d).cast("int"),
        "day_of_week": dow.cast("int"),
        "day_of_year": F.dayofyear(d).cast("int"),
        "week_of_year": F.weekofyear(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "day_name": F.date_format(d, "EEEE"),
        "month_name": F.date_format(d, "MMMM"),
        "year_month": F.date_format(d, "yyyy-MM"),
        "year_quarter": F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")),
        "is_weekend": dow.isin(1, 7),
        "is_weekday": ~dow.isin(1, 7),
    }
