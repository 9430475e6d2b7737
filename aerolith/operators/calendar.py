"""Date dimension and totals over it.

The dimension is dense: one row per day from the first to the last day of any
dated table, whether or not something happened on it. Facts are summed per key
first (partial sums in each task) and joined to it, so the join carries days,
not rows; a day without facts gets zeros.

Totals over several levels come from one pass: the facts are summed once on the
finest level, and only those sums are expanded by ``GROUPING SETS`` or
``ROLLUP``. Minutes are carried as decimal sums and counts, so a mean of any
level is exact. ``grouping_id`` keeps a level's null keys (a flight without
airport) apart from keys that the level does not have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions import route_key, safe_rate
from aerolith.operators.quality import union_all

# Total levels of flights and of passenger communication.
FLIGHT_KEYS = ("flight_date", "route", "origin_airport", "destination_airport", "status")
FLIGHT_LEVELS = (
    ("flight_date", "route", "origin_airport", "destination_airport", "status"),
    ("flight_date", "route"),
    ("flight_date", "origin_airport"),
    ("flight_date", "destination_airport"),
    ("flight_date", "status"),
    ("flight_date",),
    ("route",),
    ("origin_airport",),
    ("destination_airport",),
    ("status",),
    (),
)
EVENT_KEYS = ("event_date", "event_type", "channel", "route")
EVENT_LEVELS = (
    ("event_date", "event_type", "channel"),
    ("event_date", "event_type"),
    ("event_date", "channel"),
    ("event_date", "route"),
    ("event_date",),
    ("event_type", "channel"),
    ("event_type",),
    ("channel",),
    ("route",),
    (),
)
MEASURES = ("total_flights", "delayed_flights", "cancelled_flights")


def date_dimension(*dated: DataFrame, whole_months: bool = False) -> DataFrame:
    """One row per day from the earliest to the latest date of the given
    one-column frames (dates or timestamps, nulls ignored), or of their months:
    the date, its year, quarter, month, day of month, ISO week and weekday (1 is
    Monday), whether it is a weekend, and its month's first day. Empty if there
    is no date."""
    days = union_all([d.select(F.to_date(F.col(d.columns[0])).alias("date")) for d in dated])
    first, last = F.min("date"), F.max("date")
    if whole_months:
        first, last = F.trunc(first, "month").cast("date"), F.last_day(last)
    span = days.agg(first.alias("first"), last.alias("last"))
    dense = span.where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias("date"))
    weekday = (F.weekday("date") + 1).cast("int")
    return dense.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.weekofyear("date").alias("iso_week"),
        weekday.alias("iso_weekday"),
        (weekday >= 6).alias("is_weekend"),
        F.trunc("date", "month").alias("month_start"),
    )


def _flight_sums(flights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts and minutes per key: the measures of A1, still additive."""
    facts = flights.select(
        F.to_date("scheduled_departure_utc").alias("flight_date"),
        route_key().alias("route"),
        "origin_airport",
        "destination_airport",
        "status",
        "flight_id",
        "is_delayed",
        "is_cancelled",
        F.col("departure_delay_minutes").cast("decimal(18,2)").alias("minutes"),
    )
    return facts.groupBy(*keys).agg(
        F.count("flight_id").alias("total_flights"),
        F.count_if("is_delayed").alias("delayed_flights"),
        F.count_if("is_cancelled").alias("cancelled_flights"),
        F.sum("minutes").alias("minutes"),
        F.count("minutes").alias("timed"),
    )


def _summed() -> list[Column]:
    return [
        *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES],
        F.sum("minutes").alias("minutes"),
        F.coalesce(F.sum("timed"), F.lit(0)).alias("timed"),
    ]


def _finished() -> list[Column]:
    """The measures of A1 from sums: counts, mean delay, delay rate."""
    return [
        *MEASURES,
        F.try_divide(F.col("minutes").cast("double"), F.col("timed").cast("double")).alias("average_departure_delay_minutes"),
        safe_rate("delayed_flights", "total_flights").alias("delay_rate"),
    ]


def _level_name(keys: Sequence[str], levels: Sequence[Sequence[str]]) -> Column:
    """The level of a row, by which keys ``grouping_id`` says it lacks."""
    out = None
    for level in levels:
        lacking = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in level)
        name = F.lit(", ".join(level) or "all")
        out = (F.when if out is None else out.when)(F.col("_lacking") == lacking, name)
    return out


def flights_by_day(flights: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per day of the calendar with its attributes and the flights
    scheduled on it; days without flights count zero."""
    per_day = _flight_sums(flights, ["flight_date"])
    dense = calendar.join(per_day, F.col("date") == F.col("flight_date"), "left").drop("flight_date")
    zeros = dense.select(*calendar.columns, *[F.coalesce(m, F.lit(0)).alias(m) for m in MEASURES], "minutes", "timed")
    return zeros.select(*calendar.columns, *_finished())


def calendar_rollup(flights: DataFrame, calendar: DataFrame) -> DataFrame:
    """``ROLLUP`` of the dense days: every day, every month, every year and the
    whole calendar, each with the number of its days and of those without flights."""
    per_day = _flight_sums(flights, ["flight_date"])
    dense = calendar.join(per_day, F.col("date") == F.col("flight_date"), "left")
    levels = ((), ("year",), ("year", "month"), ("year", "month", "date"))
    total = dense.rollup("year", "month", "date").agg(
        F.grouping_id().alias("_lacking"),
        F.count(F.lit(1)).alias("days"),
        F.count_if(F.col("flight_date").isNull()).alias("days_without_flights"),
        *_summed(),
    )
    level = _level_name(("year", "month", "date"), levels)
    return total.select(level.alias("level"), "year", "month", "date", "days", "days_without_flights", *_finished())


def flight_totals(flights: DataFrame, levels: Sequence[Sequence[str]] = FLIGHT_LEVELS) -> DataFrame:
    """Flight measures of every level in ``levels``, with the level's name. No
    flights give no rows, at no level."""
    finest = _flight_sums(flights, FLIGHT_KEYS)
    total = finest.groupingSets([[F.col(k) for k in level] for level in levels], *FLIGHT_KEYS).agg(
        F.grouping_id().alias("_lacking"), *_summed()
    )
    return total.select(_level_name(FLIGHT_KEYS, levels).alias("level"), *FLIGHT_KEYS, *_finished())


def communication_totals(events: DataFrame, flights: DataFrame, levels: Sequence[Sequence[str]] = EVENT_LEVELS) -> DataFrame:
    """Events, and those of delayed and cancelled flights, of every level. They
    are counted per flight before the join, so a flight's many events meet it as
    a few rows; events of unknown flights have no route and count as neither."""
    per_flight = events.groupBy("flight_id", F.to_date("event_timestamp_utc").alias("event_date"), "event_type", "channel").agg(
        F.count(F.lit(1)).alias("events")
    )
    slim = flights.select("flight_id", route_key().alias("route"), "is_delayed", "is_cancelled")
    n = F.col("events")
    finest = per_flight.join(slim, "flight_id", "left").groupBy(*EVENT_KEYS).agg(
        F.sum(n).alias("events"),
        F.sum(F.when(F.col("is_delayed"), n).otherwise(0)).alias("delayed_flight_events"),
        F.sum(F.when(F.col("is_cancelled"), n).otherwise(0)).alias("cancelled_flight_events"),
    )
    measures = ("events", "delayed_flight_events", "cancelled_flight_events")
    total = finest.groupingSets([[F.col(k) for k in level] for level in levels], *EVENT_KEYS).agg(
        F.grouping_id().alias("_lacking"), *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in measures]
    )
    return total.select(_level_name(EVENT_KEYS, levels).alias("level"), *EVENT_KEYS, *measures)
