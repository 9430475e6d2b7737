"""Ranked reports over the gold tables (R1–R3) as DataFrame operators.

A report has a total order; ``run_report`` returns its rows in that order with
their positions. Ranking is over one row per route, airport or segment, not
over flights or events, so one task's window is bounded by the network.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.ordering import ascending, descending, positioned


def percent(rate: str | Column) -> Column:
    """A rate as a percentage of two decimals."""
    return F.round((F.col(rate) if isinstance(rate, str) else rate) * F.lit(100), 2)


def share_percent(part: str, whole: str) -> Column:
    """``part`` of ``whole`` as a percentage; null for nothing."""
    return percent(F.try_divide(F.col(part), F.col(whole)))


@dataclass(frozen=True)
class Report:
    """Gold table, its total order, and the columns to show."""

    table: str
    order: Callable[[], list[Column]]
    columns: Callable[[], list[str | Column]]
    only: Callable[[], Column] | None = None


def _route_delay_columns() -> list[str | Column]:
    ranked = Window.orderBy(*descending("delay_rate", "average_departure_delay_minutes"))
    return [
        "route",
        F.rank().over(ranked).alias("disruption_rank"),
        "total_flights",
        "delayed_flights",
        "cancelled_flights",
        percent("delay_rate").alias("delay_rate_pct"),
        F.round("average_departure_delay_minutes", 2).alias("average_departure_delay_minutes"),
    ]


REPORTS: dict[str, Report] = {
    # Which routes have the highest delay impact; ranked on unrounded values.
    "route_delay": Report(
        "gold_route_performance",
        lambda: [*descending("delay_rate", "average_departure_delay_minutes"), *ascending("route")],
        _route_delay_columns,
        lambda: F.col("total_flights") > 0,
    ),
    # R2: which origin airports contribute most to departure disruption.
    "airport_disruption": Report(
        "gold_airport_disruption",
        lambda: [
            *descending("delay_rate", "cancelled_departures", "average_departure_delay_minutes"),
            *ascending("origin_airport"),
        ],
        lambda: [
            *("origin_airport", "airport_name", "city", "country"),
            *("total_departures", "delayed_departures", "cancelled_departures"),
            percent("delay_rate").alias("delay_rate_pct"),
            F.round("average_departure_delay_minutes", 2).alias("average_departure_delay_minutes"),
        ],
        lambda: F.col("total_departures") > 0,
    ),
    # Which channels are most active around disrupted flights.
    "passenger_communication": Report(
        "gold_passenger_communication",
        lambda: [
            *descending("delayed_flight_events", "cancelled_flight_events", "event_count"),
            *ascending("route", "event_type", "channel"),
        ],
        lambda: [
            *("route", "event_type", "channel", "event_count", "delayed_flight_events", "cancelled_flight_events"),
            share_percent("delayed_flight_events", "event_count").alias("delayed_event_share_pct"),
            share_percent("cancelled_flight_events", "event_count").alias("cancelled_event_share_pct"),
        ],
    ),
}


def report(name: str) -> Report:
    if name not in REPORTS:
        raise ValueError(f"Unknown report: {name}")
    return REPORTS[name]


def run_report(name: str, table: DataFrame) -> DataFrame:
    """Report ``name`` over its gold table, in report order, with positions."""
    wanted = report(name)
    rows = table if wanted.only is None else table.where(wanted.only())
    return positioned(rows, wanted.order(), wanted.columns())
