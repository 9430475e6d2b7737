"""Dashboard and notebook metrics on small frames."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from aerolith.functions import WIND_BUCKET_LABELS, wind_bucket_index
from aerolith.operators import insights
from aerolith.operators.asof import weather_asof


def perf(spark, rows):
    schema = (
        "flight_id string, route string, is_delayed boolean, is_cancelled boolean, "
        "departure_delay_minutes double, origin_wind_speed_kmh double"
    )
    return spark.createDataFrame(rows, schema)


def test_kpis(spark):
    minutes = [0.0, 7.5, 15.0, 15.01, 62.25, None, 3.24]
    rows = [(f"K{i}", "OSL-TRD", m is not None and m > 15, i % 4 == 1, m, float(i)) for i, m in enumerate(minutes)]
    (k,) = insights.calculate_kpis(perf(spark, rows)).collect()
    counts = (k.total_flights, k.delayed_flights, k.cancelled_flights)
    assert counts == (len(rows), sum(r[2] for r in rows), sum(r[3] for r in rows))
    assert k.delay_rate == counts[1] / counts[0]
    known = [m for m in minutes if m is not None]
    assert k.average_departure_delay_minutes == pytest.approx(sum(known) / len(known))


def test_kpis_on_empty_input(spark):
    k = insights.calculate_kpis(perf(spark, [])).collect()[0]
    assert tuple(k) == (0, 0, 0, 0.0, 0.0)


def test_wind_bucket_edges(spark):
    winds = [-1.0, 0.0, 15.0, 15.0001, 25.0, 35.0, 100.0, 100.1, None]
    df = spark.createDataFrame([(w,) for w in winds], "w double")
    got = [r.b for r in df.select(wind_bucket_index("w").alias("b")).collect()]
    assert got == [None, 1, 1, 2, 2, 3, 4, None, None]


def test_weather_summary_edges(spark):
    const = perf(spark, [("A", "R", False, False, 1.0, 10.0), ("B", "R", False, False, 5.0, 10.0)])
    assert tuple(insights.calculate_weather_delay_summary(const).collect()[0]) == (10.0, None)
    one = perf(spark, [("A", "R", False, False, 1.0, 10.0)])
    assert tuple(insights.calculate_weather_delay_summary(one).collect()[0]) == (None, None)
    empty = perf(spark, [])
    assert tuple(insights.calculate_weather_delay_summary(empty).collect()[0]) == (None, None)
    pos = perf(spark, [("A", "R", False, False, 1.0, 10.0), ("B", "R", True, False, 30.0, 40.0), ("C", "R", False, False, None, 5.0)])
    avg, corr = insights.calculate_weather_delay_summary(pos).collect()[0]
    assert avg == 25.0 and corr == pytest.approx(1.0)


def test_weather_view_and_risk_matrix(spark):
    rows = [(f"F{i}", "GDN-FRA" if i % 2 else "FRA-GDN", i % 3 == 0, False, float(i), float(i * 4 % 110)) for i in range(60)]
    df = perf(spark, rows)
    view = insights.build_weather_delay_view(df).collect()
    assert [r.wind_bucket for r in view] == sorted({r.wind_bucket for r in view}, key=WIND_BUCKET_LABELS.index)
    in_range = sum(1 for r in rows if 0 <= r[5] <= 100)
    assert sum(r.total_flights for r in view) == in_range
    heat = insights.build_delay_risk_heatmap(df, 5)
    assert heat.columns == ["route", *WIND_BUCKET_LABELS]
    cells = [v for r in heat.collect() for v in r[1:] if v is not None]
    assert cells and all(0 <= v <= 1 for v in cells)
    assert insights.build_delay_risk_heatmap(df, 1000).count() == 0
    missing = insights.build_weather_delay_view(df.drop("origin_wind_speed_kmh"))
    assert missing.count() == 0 and "wind_bucket" in missing.columns


def test_filters_and_top_n(spark):
    df = perf(spark, [("A", "R1", True, False, 20.0, 30.0), ("B", "R2", False, True, 0.0, None), ("C", "R1", True, False, 30.0, 50.0)])
    f = insights.filter_flight_performance(df, delayed_only=True, wind_speed_range=(25.0, 45.0))
    assert [r.flight_id for r in f.collect()] == ["A"]
    assert insights.filter_flight_performance(df).count() == 3
    tables = {"flight_performance": df, "airport_disruption": df.select(F.lit("GDN").alias("origin_airport"))}
    out = insights.filter_tables_by_routes(tables, ["R2"])
    assert out["flight_performance"].count() == 1 and out["airport_disruption"].count() == 3
    routes = spark.createDataFrame(
        [("R1", 10, 5, 1, 12.0, 0.5), ("R2", 20, 2, 3, 30.0, 0.1), ("R3", 5, 5, 0, 8.0, 1.0)],
        "route string, total_flights long, delayed_flights long, cancelled_flights long, "
        "average_departure_delay_minutes double, delay_rate double",
    )
    assert [r.route for r in insights.sort_and_limit_routes(routes, "Delay rate", 2).collect()] == ["R3", "R1"]
    assert [r.route for r in insights.sort_and_limit_routes(routes, "Total flights", 1).collect()] == ["R2"]
    assert [r.route for r in insights.filter_route_performance(routes, 0.5).collect()] == ["R1", "R3"]
    with pytest.raises(ValueError):
        insights.sort_and_limit_routes(routes, "Nope", 1)


def test_delay_distribution_matches_numpy(spark):
    import numpy as np

    values = [1.0, 2.0, 4.0, 10.0, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "departure_delay_minutes double")
    got = {r.metric: r.departure_delay_minutes for r in insights.delay_distribution(df).collect()}
    assert got["p90"] == pytest.approx(np.percentile(values, 90))
    assert got["p50"] == pytest.approx(np.percentile(values, 50))
    assert (got["min"], got["max"], got["mean"]) == (0.0, 10.0, pytest.approx(3.4))


def test_weather_asof_backward_and_nearest(spark):
    u = timezone.utc
    flights = spark.createDataFrame(
        [("F1", "GDN", datetime(2026, 5, 6, 12, 0, tzinfo=u)), ("F2", "GDN", datetime(2026, 5, 6, 23, 0, tzinfo=u)),
         ("F3", "WAW", datetime(2026, 5, 6, 12, 0, tzinfo=u))],
        "flight_id string, origin_airport string, scheduled_departure_utc timestamp",
    )
    weather = spark.createDataFrame(
        [("GDN", datetime(2026, 5, 6, 11, 0, tzinfo=u), 1.0, 10.0, 0.0),
         ("GDN", datetime(2026, 5, 6, 12, 30, tzinfo=u), 2.0, 20.0, 0.0),
         ("GDN", datetime(2026, 5, 6, 5, 59, tzinfo=u), 3.0, 30.0, 0.0)],
        "airport_code string, observed_at_utc timestamp, temperature_c double, wind_speed_kmh double, precipitation_mm double",
    )
    back = {r.flight_id: r for r in weather_asof(flights, weather, 6 * 3600, "backward").collect()}
    assert back["F1"].origin_wind_speed_kmh == 10.0
    assert back["F2"].origin_wind_speed_kmh is None  # nearest earlier one is 10.5 h old
    assert back["F3"].origin_wind_speed_kmh is None
    near = {r.flight_id: r for r in weather_asof(flights, weather, 6 * 3600, "nearest").collect()}
    assert near["F1"].origin_wind_speed_kmh == 20.0  # 30 min after beats 60 min before
    assert len(near) == 3


@pytest.mark.parametrize("direction", ["backward", "nearest"])
def test_weather_asof_equals_comparing_every_pair(spark, direction):
    import random

    rng = random.Random(5)
    base = int(datetime(2026, 1, 1, tzinfo=timezone.utc).timestamp())
    step = 600
    flights = [(rng.choice([f"F{i}", None, "same"]), rng.choice("ABC"), base + rng.randrange(0, 400) * step) for i in range(300)]
    flights += [("N1", None, base), ("N2", "A", None), (None, None, None)]
    obs = list({(rng.choice("AB"), base + rng.randrange(-50, 450) * step) for _ in range(120)})
    fdf = spark.createDataFrame(flights, "flight_id string, origin_airport string, s long").selectExpr(
        "flight_id", "origin_airport", "timestamp_seconds(s) AS scheduled_departure_utc"
    )
    wdf = spark.createDataFrame([(a, s, float(s - base)) for a, s in obs] + [(None, base, 0.0), ("A", None, 0.0)], "airport_code string, s long, w double")
    wdf = wdf.selectExpr("airport_code", "timestamp_seconds(s) AS observed_at_utc", "0D AS temperature_c", "w AS wind_speed_kmh", "0D AS precipitation_mm")
    tolerance = 7 * step

    def best(airport, t):
        if airport is None or t is None:
            return None
        gaps = [(abs(t - s), s) for a, s in obs if a == airport and abs(t - s) <= tolerance and (direction == "nearest" or s <= t)]
        return float(min(gaps)[1] - base) if gaps else None

    wanted = sorted(str((f, a, best(a, t))) for f, a, t in flights)
    for buckets in (1, 4):
        out = weather_asof(fdf, wdf, tolerance, direction, buckets_per_tolerance=buckets)
        assert out.columns[:3] == fdf.columns
        got = sorted(str((r.flight_id, r.origin_airport, r.origin_wind_speed_kmh)) for r in out.collect())
        assert got == wanted


def test_future_events_and_time_zones(spark):
    from aerolith.operators import quality

    u = timezone.utc
    ev = spark.createDataFrame(
        [("e1", datetime(2020, 1, 1, tzinfo=u)), ("e2", datetime(2999, 1, 1, tzinfo=u))],
        "event_id string, event_timestamp_utc timestamp",
    )
    assert [r.event_id for r in quality.future_events(ev).collect()] == ["e2"]
    assert quality.future_events(ev, F.lit("2000-01-01").cast("timestamp")).count() == 2
    airports = spark.createDataFrame(
        [("GDN", "Europe/Warsaw"), ("XXX", "Mars/Olympus"), ("YYY", None)], "airport_code string, timezone string"
    )
    assert [r.airport_code for r in quality.invalid_time_zones(airports).collect()] == ["XXX"]


def test_dashboard_views_chain(spark):
    flights = perf(spark, [("A", "R1", True, False, 20.0, 30.0), ("B", "R2", False, True, 0.0, 10.0), ("C", "R1", False, False, 3.0, 50.0)])
    routes = spark.createDataFrame(
        [("R1", 2, 1, 0, 11.5, 0.5), ("R2", 1, 0, 1, 0.0, 0.0)],
        "route string, total_flights long, delayed_flights long, cancelled_flights long, "
        "average_departure_delay_minutes double, delay_rate double",
    )
    airports = spark.createDataFrame(
        [("GDN", "G", "G", "PL", 3, 1, 1, 0.33, 7.0)],
        "origin_airport string, airport_name string, city string, country string, total_departures long, "
        "delayed_departures long, cancelled_departures long, delay_rate double, average_departure_delay_minutes double",
    )
    comm = spark.createDataFrame(
        [("R1", "mobile_check_in", "web", 2, 1, 0), ("R2", "mobile_check_in", "web", 1, 0, 1)],
        "route string, event_type string, channel string, event_count long, delayed_flight_events long, "
        "cancelled_flight_events long",
    )
    tables = {"flight_performance": flights, "route_performance": routes, "airport_disruption": airports,
              "passenger_communication": comm}
    views = insights.dashboard_views(tables, ["R1"], delayed_only=True)
    assert tuple(views["kpis"].collect()[0])[:3] == (1, 1, 0)
    assert [r.route for r in views["routes"].collect()] == ["R1"]
    assert views["airports"].count() == 1 and views["communication"].count() == 1


def test_delay_distribution_approximate_option(spark):
    df = spark.range(10_000).selectExpr("cast(id % 997 as double) / 10 as departure_delay_minutes")
    exact = {r.metric: r.departure_delay_minutes for r in insights.delay_distribution(df).collect()}
    approx = {r.metric: r.departure_delay_minutes for r in insights.delay_distribution(df, exact=False).collect()}
    assert approx["min"] == exact["min"] and approx["max"] == exact["max"]
    assert abs(approx["p90"] - exact["p90"]) <= 0.2 and abs(approx["p50"] - exact["p50"]) <= 0.2


def test_mean_minutes_is_the_plain_mean_of_two_decimal_values(spark):
    from aerolith.functions import mean_minutes

    values = spark.createDataFrame([(15.28,), (0.01,), (3.0,), (None,)], "x double")
    assert values.agg(mean_minutes("x")).first()[0] == pytest.approx((15.28 + 0.01 + 3.0) / 3)
    assert values.where("x < 0").agg(mean_minutes("x")).first()[0] is None
