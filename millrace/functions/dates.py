"""Date predicates."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd"


def iso_period(text: str) -> tuple[dt.date, dt.date] | None:
    """First day and first day after the year, month or day ``text`` names, if it names one."""
    match = re.fullmatch(r"(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?", text)
    if not match:
        return None
    year, month, day = (int(part) if part else None for part in match.groups())
    try:
        start = dt.date(year, month or 1, day or 1)
        if day:
            return start, start + dt.timedelta(days=1)
        if month:
            return start, dt.date(year + month // 12, month % 12 + 1, 1)
        return start, dt.date(year + 1, 1, 1)
    except (ValueError, OverflowError):
        return None


def date_contains(date: Column, text: str) -> Column:
    """True where the ISO form of ``date`` contains ``text``.

    A whole year, month or day can only match at its own place, so it becomes a range on the typed
    column, which the scan can prune by; any other piece of a date is looked up in the formatted one.
    """
    period = iso_period(text)
    if period:
        return (date >= F.lit(period[0])) & (date < F.lit(period[1]))
    return F.date_format(date, ISO_FORMAT).contains(text)


def month_of(date: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(date, "yyyy-MM")


def date_after(date: Column, text: str) -> Column:
    """True where the ISO form of ``date`` sorts after ``text``; a date sorts after its own year or month."""
    period = iso_period(text)
    if period:
        return date >= F.lit(period[1] if len(text) == len("YYYY-MM-DD") else period[0])
    return F.date_format(date, ISO_FORMAT) > text


def date_before(date: Column, text: str) -> Column:
    """True where the ISO form of ``date`` sorts before ``text``."""
    period = iso_period(text)
    if period:
        return date < F.lit(period[0])
    return F.date_format(date, ISO_FORMAT) < text
