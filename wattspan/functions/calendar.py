"""Calendar and time-band expressions over zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
GRAINS = ("hour", "day", "month", "year", "band")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate(ts: Column | str, unit: str) -> Column:
    """Start of the hour, day, month or year, still without a zone."""
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def floor_minutes(ts: Column | str, minutes: int) -> Column:
    """Start of the slot of ``minutes`` (a divisor of 60) that holds ``ts``."""
    into = (F.floor(F.minute(_col(ts)) / minutes) * minutes).cast("int")
    return truncate(ts, "hour") + F.make_dt_interval(F.lit(0), F.lit(0), into)


def parse_text(text: Column | str, fmt: str = TEXT_FORMAT) -> Column:
    return F.to_timestamp_ntz(_col(text), F.lit(fmt))


def from_epoch(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_col(seconds)).cast("timestamp_ntz")


def time_band(ts: Column | str) -> Column:
    """1 before 09:00, 2 before 19:00, 3 after; NULL for a missing time."""
    hour = F.hour(_col(ts))
    return F.when(hour < 9, 1).when(hour < 19, 2).when(hour >= 19, 3)


def dow_sun0(ts: Column | str) -> Column:
    """Day of week with Sunday as 0: the code stored in the tables."""
    return F.dayofweek(_col(ts)) - 1


def dow_mon0(ts: Column | str) -> Column:
    """Day of week with Monday as 0: the code used by features and forecasts."""
    return F.weekday(_col(ts))


def month_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def date_text(ts: Column | str) -> Column:
    """Year-month-day without zero padding."""
    c = _col(ts)
    return F.concat_ws("-", F.year(c), F.month(c), F.dayofmonth(c))


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    c = _col(ts)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "hour": F.hour(c),
        "dow": dow_mon0(c),
    }


def bucket_columns(ts: Column | str, grain: str) -> dict[str, Column]:
    """Grouping columns of a grain, derived from a reading's time."""
    if grain == "band":
        return {"day": F.to_date(_col(ts)), "band": time_band(ts)}
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    return {"ts": truncate(ts, grain)}
