"""Calendar expressions. All of them are plain date arithmetic, free of the session time zone."""

from __future__ import annotations

import datetime as dt


def as_date(day: dt.date | str | None = None) -> str:
    """The reporting date: a given day, or the day of the run."""
    return "current_date()" if day is None else f"DATE'{dt.date.fromisoformat(str(day))}'"


def week_start(day: str) -> str:
    """Monday of the week."""
    return f"date_sub(CAST({day} AS DATE), weekday(CAST({day} AS DATE)))"


def week_end(day: str) -> str:
    """Sunday of the week."""
    return f"date_add({week_start(day)}, 6)"


def week_number(day: str) -> str:
    """The week as an integer ``YYYYWW``; groups as ``week_key`` does, at a smaller size."""
    monday = week_start(day)
    return f"(year({monday}) * 100 + weekofyear({monday}))"


def week_text(number: str) -> str:
    """``YYYY-WW`` of a week number."""
    return f"concat(CAST({number} DIV 100 AS STRING), '-', lpad(CAST({number} % 100 AS STRING), 2, '0'))"


def week_key(day: str) -> str:
    """``YYYY-WW``: calendar year of the Monday and its ISO week number.

    A Monday of late December that opens ISO week 1 keeps its own year
    (2024-12-30 is ``2024-01``); ``iso_week_key`` gives ``2025-01``.
    """
    return week_text(week_number(day))


def iso_week_key(day: str) -> str:
    """``YYYY-WW`` with the ISO week-numbering year, which is that of the Thursday."""
    monday = week_start(day)
    return week_text(f"(year(date_add({monday}, 3)) * 100 + weekofyear({monday}))")


def in_later_week(day: str, last: str) -> str:
    """Whether the day surely lies in a week with a greater ``week_key`` than that of ``last``, decided by dates alone.

    A Monday of late December may open week 1 of its own year. So days around the end of a year count as not later, as
    do those of the year of such a ``last``: whoever needs them told apart compares the keys.
    """
    date, year = f"CAST({day} AS DATE)", f"year({week_start(last)})"
    same_year = f"{date} > {week_end(last)} AND {date} <= make_date({year}, 12, 28)"
    return f"({same_year} OR {date} >= make_date({year} + 1, 1, 7) AND {date} <= DATE'9999-12-31')"


def slash_date(day: str) -> str:
    return f"date_format(CAST({day} AS DATE), 'yyyy/MM/dd')"


def wall_micros(ts: str) -> str:
    """Microseconds on the wall clock since 1970-01-01, whatever the session time zone is."""
    days = f"CAST(datediff(CAST({ts} AS DATE), DATE'1970-01-01') AS BIGINT)"
    seconds = f"{days} * 86400 + hour({ts}) * 3600 + minute({ts}) * 60"
    return f"(({seconds}) * 1000000 + CAST(extract(SECOND FROM {ts}) * 1000000 AS BIGINT))"


def minutes_between(start_micros: str, end_micros: str) -> str:
    """Whole minutes, truncated; NULL unless the end is strictly later."""
    gap = f"({end_micros} - {start_micros})"
    return f"CASE WHEN {gap} > 0 THEN {gap} DIV 60000000 END"
