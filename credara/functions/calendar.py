"""Calendar attributes of a date column."""

from datetime import date

from pyspark.sql import Column, functions as F

from credara.schemas import MONTHS, WEEKDAYS


def _pick(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), position)


def date_key(d: Column) -> Column:
    """Smart key: 2024-03-05 -> 20240305."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def in_days(key: str, start: date, end: date) -> Column:
    """Is a smart date key between two days, both included?"""
    low, high = (d.year * 10000 + d.month * 100 + d.day for d in (start, end))
    return F.col(key).between(low, high)


def month_name(d: Column) -> Column:
    return _pick(MONTHS, F.month(d))


def weekday_number(d: Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(d) - 1


def weekday_name(d: Column) -> Column:
    return _pick(WEEKDAYS, F.dayofweek(d))


def is_weekend(d: Column) -> Column:
    return F.coalesce(F.dayofweek(d).isin(1, 7), F.lit(False))
