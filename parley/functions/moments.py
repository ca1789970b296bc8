"""Dates and times.

Timestamps are naive (``timestamp_ntz``) and never pass through the session's zone: everything is built from
calendar parts, date arithmetic and intervals, so results are the same in every zone.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.rules import between_rule

# The English names of the days, and the parts of the day and week below. The store's epoch is 2001-01-01.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def naive(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def epoch_ns(ns: Column) -> Column:
    """Nanoseconds since 2001-01-01 -> naive timestamp.

    The value passes through double seconds and is rounded to the nearest microsecond, so it agrees
    with an engine that adds a fractional-second interval.
    """
    micros = F.rint(ns / F.lit(1e9) * F.lit(1e6)).cast("bigint")
    return F.expr("timestamp_ntz '2001-01-01 00:00:00'") + micros * F.expr("interval '0.000001' second")


def epoch_ns_or_null(ns: Column) -> Column:
    """As ``epoch_ns``, with 0 meaning "never happened"."""
    return F.when(ns != 0, epoch_ns(ns))


def _minutes(ts: Column) -> Column:
    """Whole minutes since 1970."""
    return (F.unix_date(F.to_date(ts)) * 1440 + F.hour(ts) * 60 + F.minute(ts)).cast("bigint")


def _seconds(ts: Column) -> Column:
    """Whole seconds since 1970."""
    return _minutes(ts) * 60 + F.second(ts)


def micros(ts: Column) -> Column:
    """Naive timestamp -> microseconds since 1970."""
    second = F.extract(F.lit("SECOND"), ts)
    return _minutes(ts) * 60_000_000 + (second * 1_000_000).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:00 is 1."""
    return _minutes(end) - _minutes(start)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed."""
    return _seconds(end) - _seconds(start)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def truncated(unit: str, ts: Column) -> Column:
    """Start of the hour, day, week (Monday), month, quarter or year.

    This is date arithmetic, as truncating passes through the session's zone.
    """
    day = F.to_date(ts)
    if unit == "hour":
        return naive(day) + F.hour(ts) * F.expr("interval '1' hour")
    return naive(day if unit == "day" else F.trunc(day, unit))


def time_dims(ts: Column) -> dict[str, Column]:
    """Truncations and calendar parts of one timestamp; ``day_of_week`` counts from Sunday = 0."""
    return {
        "message_hour": truncated("hour", ts),
        "message_date_day": truncated("day", ts),
        "message_week": truncated("week", ts),
        "message_month": truncated("month", ts),
        "message_quarter": truncated("quarter", ts),
        "message_year": truncated("year", ts),
        "hour_of_day": F.hour(ts).cast("bigint"),
        "day_of_week": (F.dayofweek(ts) - 1).cast("bigint"),
        "day_of_month": F.dayofmonth(ts).cast("bigint"),
        "month_of_year": F.month(ts).cast("bigint"),
        "year": F.year(ts).cast("bigint"),
    }


def time_classes(ts: Column) -> dict[str, Column]:
    """Part of the day, weekday or weekend, and the English day name."""
    weekday = F.dayofweek(ts) - 1
    return {
        "time_of_day": between_rule(
            F.hour(ts), [(6, 11, "morning"), (12, 17, "afternoon"), (18, 21, "evening")], "night"
        ),
        "day_type": F.when(weekday.isin(0, 6), "weekend").otherwise("weekday"),
        "day_name": F.get(F.array(*map(F.lit, DAY_NAMES)), weekday),
    }
