"""Date column builders (all native expressions: stay inside whole-stage codegen).

Text dates arrive as month/day/year. Two parse modes:

* ``lenient`` (default) follows a lenient calendar: the first three slash-separated digit
  runs are read as month, day, year, and out-of-range parts roll over
  (``25/12/2014`` -> 2016-01-12, ``2/30/2014`` -> 2014-03-02, ``1/5/2014x`` -> 2014-01-05,
  ``01/05/14`` -> year 14). Text without that shape is NULL, and so is one whose numbers or date
  go beyond year 9999; digits are never cut off.
* ``strict`` accepts only real calendar dates: month/day/year first, then day/month/year.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The three digit runs; zeros in front aside, longer ones lead beyond year 9999 whatever the rest says.
_MDY = r"^0*\d{1,6}/0*\d{1,7}/0*\d{1,4}(?!\d)"
_MAX_YEAR = 9999


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it: the value is the
    one element of an array, and the body a function applied to it. Catalyst can't copy the value
    into its uses there, as it does with a projected column."""
    return F.get(F.transform(F.array(value), body), 0)


def _rolled(parts: Column) -> Column:
    m, d, y = (F.get(parts, i).try_cast("int") for i in range(3))
    return F.date_add(F.add_months(F.make_date(y, F.lit(1), F.lit(1)), m - 1), d - 1)


def parse_date(text: Column | str, mode: str = "lenient") -> Column:
    """Text -> DATE. NULL, blank and unparseable text give NULL (never an error). The text is matched
    once per evaluation, and the date is computed once from the matched digits."""
    t = F.trim(_c(text))
    if mode == "strict":
        return F.coalesce(F.try_to_date(t, "M/d/yyyy"), F.try_to_date(t, "d/M/yyyy"))
    if mode != "lenient":
        raise ValueError(f"unknown date mode {mode!r}")
    date = let(F.split(F.regexp_extract(t, _MDY, 0), "/"), _rolled)
    return let(date, lambda d: F.when(F.year(d).between(0, _MAX_YEAR), d))


def split_date_parts(text: Column | str) -> tuple[Column, Column, Column]:
    """Strict positional split ``M/D/Y`` -> (year, month, day) INTs; bad or missing part -> NULL."""
    parts = F.split(_c(text), "/")
    return (
        F.get(parts, 2).try_cast("int"),
        F.get(parts, 0).try_cast("int"),
        F.get(parts, 1).try_cast("int"),
    )


def year_month_key(date: Column | str) -> Column:
    """Zero-padded ``yyyy-MM`` key."""
    return F.date_format(_c(date), "yyyy-MM")


def year_month_text(year: Column | str, month: Column | str) -> Column:
    """Zero-padded ``yyyy-MM`` from integer parts (same text as :func:`year_month_key`)."""
    return F.format_string("%04d-%02d", _c(year), _c(month))


def year_month_label(year: Column | str, month: Column | str) -> Column:
    """``<year>-<MM>``: year as-is, month zero-padded."""
    return F.concat(_c(year).cast("string"), F.lit("-"), F.format_string("%02d", _c(month)))


def us_week_of_year(date: Column | str) -> Column:
    """Week of year under US rules: weeks start on Sunday, week 1 holds January 1,
    so the last days of December can already be week 1 of the next year."""
    d = _c(date)
    jan1 = F.make_date(F.year(d), F.lit(1), F.lit(1))
    next_jan1 = F.make_date(F.year(d) + 1, F.lit(1), F.lit(1))
    first_sunday_of_next_week1 = F.date_sub(next_jan1, F.dayofweek(next_jan1) - 1)
    week = F.floor((F.datediff(d, jan1) + F.dayofweek(jan1) - 1) / 7).cast("int") + 1
    return F.when(d >= first_sunday_of_next_week1, F.lit(1)).otherwise(week)


def calendar_parts(date: Column | str) -> dict[str, Column]:
    """year / month / US week of a parsed date; NULL date -> NULL parts (not 0)."""
    d = _c(date)
    return {"year": F.year(d), "month": F.month(d), "week": us_week_of_year(d)}
