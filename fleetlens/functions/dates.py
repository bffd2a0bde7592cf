"""Calendar functions.  Reference dates are arguments, never the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from fleetlens import params

# month/day with an optional two- or four-digit year; a one-digit day may be padded with a blank.
_MONTH_DAY_YEAR = r"^(1[0-2]|0?[1-9])/(3[01]|[12][0-9]|0?[1-9]| [1-9])(/([0-9]{2}|(?!0000)[0-9]{4}))?$"


def fiscal_work_week(date: Column, anchor: str = "on_or_before") -> Column:
    """``YYYYWWNN`` in the fiscal calendar.

    Weeks run Sunday to Saturday.  The year is the ISO year; week 1 starts on the Sunday on or
    before Dec 28 of the year before, or, with ``anchor='nearest'``, on the Sunday closest to it.
    """
    if anchor not in ("on_or_before", "nearest"):
        raise ValueError(f"anchor must be 'on_or_before' or 'nearest', not {anchor!r}")
    year = F.extract(F.lit("YEAROFWEEK"), date)
    dec28 = F.make_date(year - 1, F.lit(12), F.lit(28))
    past_sunday = F.dayofweek(dec28) - 1
    start = F.date_sub(dec28, past_sunday)
    if anchor == "nearest":
        start = F.when(past_sunday > 3, F.date_add(start, 7)).otherwise(start)
    week = F.floor(F.datediff(date, start) / 7) + 1
    return F.concat(year.cast("string"), F.lit("WW"), F.lpad(week.cast("string"), 2, "0"))


def iso_yearww(date: Column, year_basis: str = "calendar") -> Column:
    """Calendar year with ISO week (2024-12-30 is ``2024WW01``); ``year_basis='iso'`` pairs ISO with ISO."""
    if year_basis not in ("calendar", "iso"):
        raise ValueError(f"year_basis must be 'calendar' or 'iso', not {year_basis!r}")
    year = F.year(date) if year_basis == "calendar" else F.extract(F.lit("YEAROFWEEK"), date)
    return F.concat(year.cast("string"), F.lit("WW"), F.lpad(F.weekofyear(date).cast("string"), 2, "0"))


def counter_date(modified: Column, days: int = params.COUNTER_DATE_SHIFT_DAYS) -> Column:
    """The day a counter file describes: its modification date shifted by ``days``."""
    return F.date_add(F.to_date(modified), days)


def parse_day_shift(day_shift: Column, asof: dt.date | Column, ahead: str = "kept") -> Column:
    """Date in front of the first dash: ``M/D``, ``M/D/YY`` or ``M/D/YYYY``; anything else is null.

    Two-digit years from 69 on are in the 1900s.  Without a year the year of ``asof`` is taken, a date or a date column,
    and Feb 29 is refused because no year says that it exists.  Such a day may lie ahead of ``asof``, as a day of December
    does in January; with ``ahead='last_year'`` it is that of the year before.
    """
    if ahead not in ("kept", "last_year"):
        raise ValueError(f"ahead must be 'kept' or 'last_year', not {ahead!r}")
    text = F.split_part(day_shift, F.lit("-"), F.lit(1))
    month = F.lpad(F.split_part(text, F.lit("/"), F.lit(1)), 2, "0")
    day = F.lpad(F.trim(F.split_part(text, F.lit("/"), F.lit(2))), 2, "0")
    year = F.split_part(text, F.lit("/"), F.lit(3))
    known = asof if isinstance(asof, Column) else F.lit(asof)
    this_year = F.year(known)
    if ahead == "last_year":
        this_year = this_year - (F.concat(month, day) > F.date_format(known, "MMdd")).cast("int")
    full_year = (
        F.when(year == "", F.lpad(this_year.cast("string"), 4, "0"))
        .when(F.length(year) == 4, year)
        .when(year >= "69", F.concat(F.lit("19"), year))
        .otherwise(F.concat(F.lit("20"), year))
    )
    leap_day_without_year = (year == "") & (month == "02") & (day == "29")
    return F.when(
        text.rlike(_MONTH_DAY_YEAR) & ~leap_day_without_year,
        F.concat_ws("-", full_year, month, day).try_cast("date"),
    )


def utc_literal(ts: dt.datetime) -> Column:
    """A point in time as a constant UTC wall-clock value, whatever the session's time zone."""
    naive = ts.astimezone(dt.timezone.utc).replace(tzinfo=None) if ts.tzinfo else ts
    return F.lit(naive.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_time(instant: Column) -> Column:
    """UTC wall-clock value of an instant, whatever the session's time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


# Shapes of dates other than ISO, each with its pattern.
_OTHER_DATES = [
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^\d{1,2}-[A-Z][a-z]{2}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
]


def warranty_start(text: Column) -> Column:
    """When a warranty began; null for a bad or missing date.

    Besides ISO texts, month/day/year (with or without a time), day-month name-year and yyyymmdd are read.
    """
    shown = text.cast("string")
    return F.coalesce(
        text.try_cast("timestamp_ntz"),
        *[
            F.when(shown.rlike(shape), F.try_to_timestamp(shown, F.lit(pattern)).cast("timestamp_ntz"))
            for shape, pattern in _OTHER_DATES
        ],
    )


def tool_age_days(start: Column, asof: dt.date) -> Column:
    """Whole days (rounded down) from ``warranty_start`` to ``asof``; null for a bad or missing date."""
    start = warranty_start(start)
    day = start.cast("date")
    started_later = start > day.cast("timestamp_ntz")
    return (F.datediff(F.lit(asof), day) - started_later.cast("int")).cast("bigint")


def age_bucket(age_days: Column) -> Column:
    """Age class of a tool of ``age_days`` days."""
    years = age_days / F.lit(params.DAYS_PER_YEAR)
    return (
        F.when(years < 1, "0_1Y")
        .when(years < 3, "1_3Y")
        .when(years < 5, "3_5Y")
        .when(years.isNotNull(), "5P_Y")
        .otherwise("UnknownAge")
    )
