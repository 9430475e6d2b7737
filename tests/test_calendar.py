"""The date dimension and totals over it."""

from __future__ import annotations

from datetime import date, datetime, timezone
from itertools import product

from pyspark.sql import functions as F

from aerolith.operators import calendar

FLIGHT = (
    "flight_id string, scheduled_departure_utc timestamp, origin_airport string, destination_airport string,"
    " status string, is_delayed boolean, is_cancelled boolean, departure_delay_minutes double"
)


def at(day, hour=12, month=12, year=2025):
    return datetime(year, month, day, hour, tzinfo=timezone.utc)


def flights(spark):
    rows = [
        ("a", at(30), "OSL", "ARN", "departed", False, False, 1.25),
        ("b", at(30, 23), "OSL", "ARN", "delayed", True, False, 40.5),
        ("c", at(30), None, "ARN", "cancelled", False, True, None),
        ("d", at(2, month=1, year=2026), "ARN", "OSL", "delayed", True, False, 20.0),
    ]
    return spark.createDataFrame(rows, FLIGHT)


def test_every_day_between_the_first_and_the_last_date(spark):
    dated = [spark.createDataFrame([(at(d),) for d in days] + [(None,)], "t timestamp") for days in ([27, 31], [29])]
    rows = calendar.date_dimension(*dated, spark.createDataFrame([(date(2026, 1, 1),)], "d date")).orderBy("date").collect()
    assert [r.date for r in rows] == [date(2025, 12, d) for d in range(27, 32)] + [date(2026, 1, 1)]
    for r in rows:
        iso = r.date.isocalendar()
        assert (r.iso_week, r.iso_weekday, r.is_weekend) == (iso.week, iso.weekday, iso.weekday > 5)
        assert (r.year, r.quarter, r.month, r.day) == (r.date.year, (r.date.month + 2) // 3, r.date.month, r.date.day)
        assert r.month_start == r.date.replace(day=1)
    months = calendar.date_dimension(*dated, whole_months=True)
    assert (months.count(), months.first().date) == (31, date(2025, 12, 1))
    for whole in (False, True):
        assert calendar.date_dimension(dated[0].where("t IS NULL"), whole_months=whole).count() == 0


def test_days_without_flights_are_zero(spark):
    days = calendar.date_dimension(flights(spark).select("scheduled_departure_utc"))
    rows = {r.date: r for r in calendar.flights_by_day(flights(spark), days).collect()}
    assert [rows[date(2025, 12, 31)][m] for m in calendar.MEASURES] == [0, 0, 0]
    assert rows[date(2026, 1, 1)].average_departure_delay_minutes is None and rows[date(2026, 1, 1)].delay_rate is None
    first = rows[date(2025, 12, 30)]
    assert tuple(first[m] for m in calendar.MEASURES) == (3, 1, 1) and first.average_departure_delay_minutes == 20.875


def test_rollup_counts_days_at_every_level(spark):
    days = calendar.date_dimension(flights(spark).select("scheduled_departure_utc"))
    rows = calendar.calendar_rollup(flights(spark), days).collect()
    got = {(r.level, r.year, r.month): (r.days, r.days_without_flights, r.total_flights) for r in rows if r.date is None}
    assert got == {
        ("all", None, None): (4, 2, 4),
        ("year", 2025, None): (2, 1, 3),
        ("year", 2026, None): (2, 1, 1),
        ("year, month", 2025, 12): (2, 1, 3),
        ("year, month", 2026, 1): (2, 1, 1),
    }
    assert sorted(r.days for r in rows if r.level == "year, month, date") == [1, 1, 1, 1]


def test_every_total_level_is_the_plain_sum(spark):
    source = [r.asDict() for r in flights(spark).withColumn("flight_date", F.to_date("scheduled_departure_utc")).collect()]
    for r in source:
        r["route"] = "-".join(x for x in (r["origin_airport"], r["destination_airport"]) if x)
    wanted = {}
    for level, r in product(calendar.FLIGHT_LEVELS, source):
        key = (", ".join(level) or "all", *(r[k] if k in level else None for k in calendar.FLIGHT_KEYS))
        wanted.setdefault(key, []).append(r)
    rows = calendar.flight_totals(flights(spark)).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        members = wanted[(r.level, *(r[k] for k in calendar.FLIGHT_KEYS))]
        assert r.total_flights == len(members) and r.delayed_flights == sum(m["is_delayed"] for m in members)
        minutes = [m["departure_delay_minutes"] for m in members if m["departure_delay_minutes"] is not None]
        assert r.average_departure_delay_minutes == (sum(minutes) / len(minutes) if minutes else None)
    # A flight without origin is a level's null key, not the level without origins.
    assert {r.total_flights for r in rows if r.level == "origin_airport" and r.origin_airport is None} == {1}
    assert calendar.flight_totals(flights(spark).limit(0)).count() == 0


def test_communication_levels(spark):
    events = spark.createDataFrame(
        [(f"e{i}", f, at(d), t, c) for i, (f, d, t, c) in enumerate([("a", 1, "x", "web"), ("b", 1, "x", "sms"), ("b", 2, "y", "sms"), ("?", 2, "y", None)])],
        "event_id string, flight_id string, event_timestamp_utc timestamp, event_type string, channel string",
    )
    rows = calendar.communication_totals(events, flights(spark)).collect()
    got = {(r.level, r.event_date, r.event_type, r.channel, r.route): (r.events, r.delayed_flight_events) for r in rows}
    assert got["all", None, None, None, None] == (4, 2)
    assert got["channel", None, None, "sms", None] == (2, 2) and got["channel", None, None, None, None] == (1, 0)
    assert got["route", None, None, None, "OSL-ARN"] == (3, 2) and got["route", None, None, None, None] == (1, 0)
    assert got["event_date, event_type", date(2025, 12, 2), "y", None, None] == (2, 1)
