"""Incident-calendar expressions: membership, horizons, remaining time.

A calendar is short and configured, so every rule is a chain of literal comparisons that
stays inside whole-stage code generation; no join and no shuffle.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom.functions.scalars import epoch_micros
from sensorloom.spec import Calendar, Interval, micros_of


def _text(moment) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f"))


def _inside(time: Column, interval: Interval) -> Column:
    return (time >= _text(interval.start)) & (time <= _text(interval.end))


def _any(tests: list[Column]) -> Column:
    return reduce(or_, tests) if tests else F.lit(False)


def in_any(time: Column, calendar: Calendar) -> Column:
    return _any([_inside(time, i) for i in calendar.intervals])


def interval_type(
    time: Column, calendar: Calendar, on_overlap: str = "last", default: str = "normal"
) -> Column:
    """Type of the covering interval; ``on_overlap`` picks the first or last listed one."""
    if on_overlap not in ("first", "last"):
        raise ValueError("on_overlap is 'first' or 'last'")
    chosen = list(calendar.intervals)
    if on_overlap == "last":
        chosen.reverse()
    # first matching branch of CASE wins, so list the winner first
    chain = F
    for interval in chosen:
        chain = chain.when(_inside(time, interval), F.lit(interval.type))
    return chain.otherwise(F.lit(default)) if chosen else F.lit(default)


def before_start(time: Column, calendar: Calendar, hours: int) -> Column:
    """In ``[start - hours, start)`` of any interval."""
    span = timedelta(hours=hours)
    return _any(
        [(time >= _text(i.start - span)) & (time < _text(i.start)) for i in calendar.intervals]
    )


def after_end(time: Column, calendar: Calendar, hours: int) -> Column:
    """In ``(end, end + hours]`` of any interval."""
    span = timedelta(hours=hours)
    return _any([(time > _text(i.end)) & (time <= _text(i.end + span)) for i in calendar.intervals])


def seconds_to_start(time: Column, calendar: Calendar) -> Column:
    """Seconds to the next start; 0 inside an interval, null after the last start."""
    chain = F.when(in_any(time, calendar), F.lit(0.0))
    for interval in calendar.by_start():
        wait = (F.lit(micros_of(interval.start)) - epoch_micros(time)) / F.lit(1e6)
        chain = chain.when(time < _text(interval.start), wait)
    return chain


def flag(test: Column) -> Column:
    return F.coalesce(test.cast("int"), F.lit(0))
