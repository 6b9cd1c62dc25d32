"""Time expressions: truncation, half-open ranges, day lists and chunk grids."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F


def ts_literal(value: str | datetime) -> Column:
    """A timestamp literal without time zone."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def start_of(grain: str, ts: Column | str) -> Column:
    """Start of the millisecond, minute, hour or day that holds ts.

    The elapsed part is subtracted. date_trunc would go through the session's time zone, which
    moves local times that a clock change skips.
    """
    at = F.col(ts) if isinstance(ts, str) else ts
    seconds = F.extract(F.lit("SECOND"), at)
    if grain == "day":
        return F.to_date(at).cast("timestamp_ntz")
    elapsed = {
        "millisecond": {"secs": seconds % F.lit("0.001").cast("decimal(8,6)")},
        "minute": {"secs": seconds},
        "hour": {"mins": F.minute(at), "secs": seconds},
    }
    if grain not in elapsed:
        raise ValueError(f"unknown grain: {grain}")
    return at - F.make_dt_interval(**elapsed[grain])


def month_key(ts: Column | str) -> Column:
    """Year and month as one number, such as 202401."""
    day = F.to_date(ts)
    return F.year(day) * 100 + F.month(day)


def in_range(ts: Column | str, start: str | datetime, end: str | datetime) -> Column:
    """start <= ts < end."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return (column >= ts_literal(start)) & (column < ts_literal(end))


def day_range(day: str | date) -> tuple[datetime, datetime]:
    """A day as a half-open range."""
    start = datetime.fromisoformat(str(day)[:10])
    return start, start + timedelta(days=1)


def window_end(start: str | datetime, hours: int) -> datetime:
    """End of a window that begins at start and lasts the given hours."""
    begin = start if isinstance(start, datetime) else datetime.fromisoformat(start)
    return begin + timedelta(hours=hours)


def days_between(first: Column, last: Column) -> Column:
    """Array of all days from first to last, both included; fails if last is before first."""
    return F.when(last < first, F.raise_error(F.lit("last day is before first day"))).otherwise(
        F.sequence(first, last)
    )


def check_chunk_minutes(minutes: int) -> int:
    if minutes <= 0 or 1440 % minutes:
        raise ValueError(f"chunk minutes must divide 1440: {minutes}")
    if minutes >= 60 and minutes % 60:
        raise ValueError(f"chunk minutes of an hour or more must be whole hours: {minutes}")
    return minutes


def chunk_starts(day: Column, minutes: int) -> Column:
    """Array of the chunk start times of a day."""
    step = F.make_dt_interval(mins=F.lit(check_chunk_minutes(minutes)))
    start = day.cast("timestamp_ntz")
    return F.sequence(start, start + F.make_dt_interval(days=F.lit(1)) - step, step)


def chunk_of(ts: Column, minutes: int) -> Column:
    """Start of the chunk that holds ts."""
    check_chunk_minutes(minutes)
    day = start_of("day", ts)
    minute_of_day = F.hour(ts) * 60 + F.minute(ts)
    return day + F.make_dt_interval(mins=minute_of_day - minute_of_day % minutes)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds between two timestamps without time zone."""
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("double")
