"""Times of loosely written manifests, always UTC (the session's zone is UTC)."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, functions as F

from eventloom.functions.clean import _col, trimmed

_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([+-]\d{2}(:?\d{2})?|Z)?)?$"


def parse_utc(c: Column | str) -> Column:
    """ISO text as a timestamp; no zone means UTC, a short zone as +00 is read."""
    t = trimmed(c)
    return F.when(t.rlike(_ISO), t.try_cast("timestamp"))


def valid_datetime(c: Column | str) -> Column:
    """Whether the text is an ISO time, or its part before the first space an ISO date."""
    t = trimmed(c)
    head = F.split_part(t, F.lit(" "), F.lit(1))
    return F.coalesce(parse_utc(t).isNotNull() | (head.rlike(r"^\d{4}-\d{2}-\d{2}$") & head.try_cast("date").isNotNull()), F.lit(False))


def row_date(c: Column | str) -> Column:
    """The date of a time text, else of what stands before T or a space; null if neither is one."""
    t = trimmed(c)
    return F.coalesce(parse_utc(t).cast("date"), F.substring_index(t, "T", 1).try_cast("date"), F.substring_index(t, " ", 1).try_cast("date"))


def iso_z(ts: Column | str) -> Column:
    """Yyyy-mm-ddThh:mm:ssZ."""
    return F.date_format(_col(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def round_hour(ts: Column | str, mode: str = "nearest") -> Column:
    """To the hour: nearest (30 minutes go up), floor or ceil."""
    t = _col(ts).cast("timestamp")
    floor = F.date_trunc("hour", t)
    if mode == "floor":
        return floor
    if mode == "nearest":
        return F.date_trunc("hour", t + F.expr("interval 30 minutes"))
    if mode == "ceil":
        return F.when(t == floor, floor).otherwise(floor + F.expr("interval 1 hour"))
    raise ValueError(f"mode: {mode}")


def stamp_in_name(c: Column | str, pattern: str = r"(\d{8}T\d{6})", form: str = "yyyyMMdd'T'HHmmss") -> Column:
    """P10: the time that a file or scene name carries."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit("")), F.lit(form))


def image_time(choices: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """The first time there is, and the name of where it is from."""
    source = functools.reduce(lambda acc, x: acc.when(x[1].isNotNull(), x[0]), choices[1:], F.when(choices[0][1].isNotNull(), choices[0][0]))
    return F.coalesce(*[t for _, t in choices]), source


def micros(ts: Column | str) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp"))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Signed days, fractions kept."""
    return (micros(later) - micros(earlier)) / F.lit(86_400e6)


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    """Signed hours."""
    return (micros(later) - micros(earlier)) / F.lit(3_600e6)


def near_any(ts: Column | str, slots: list[Column | str], window_days: float) -> Column:
    """whether any slot lies within the window on either side."""
    tests = [F.coalesce(F.abs(days_between(ts, s)) <= window_days, F.lit(False)) for s in slots]
    return functools.reduce(operator.or_, tests)


def time_decay(days: Column, tau: float) -> Column:
    """exp(-|days| / tau)."""
    return F.exp(-F.abs(days) / F.lit(tau))


def sigmoid(x: Column) -> Column:
    """P37."""
    return 1 / (1 + F.exp(-x))


def in_range(ts: Column | str, start: str | None = None, end: str | None = None) -> Column:
    """the time is at `start` or later and before `end`; either may be left open.  A null time is outside."""
    t = F.col(ts) if isinstance(ts, str) else ts
    inside = F.lit(True)
    if start is not None:
        inside = inside & (t >= F.lit(start).cast("timestamp"))
    if end is not None:
        inside = inside & (t < F.lit(end).cast("timestamp"))
    return F.coalesce(inside & t.isNotNull(), F.lit(False))
