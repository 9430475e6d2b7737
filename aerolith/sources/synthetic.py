"""Deterministic synthetic sources (S13) as Spark column expressions over
``spark.range``, so the demo data scales to any number of flights and is
generated by the executors. Records come out in the raw landing shape:
JSON text with UTC timestamp strings.

Used for demos and as the fallback source of the ingest job; registered
queries never run on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith import contracts

DEFAULT_FLIGHT_COUNT = 720
DEMO_START_EPOCH = 1777615200  # 2026-05-01T06:00:00Z
WEATHER_DAYS = 30

# Demo airports (code, name, city, country, zone, lat, lon).
AIRPORTS = (
    ("GDN", "Gdansk Lech Walesa Airport", "Gdansk", "Poland", "Europe/Warsaw", 54.3776, 18.4662),
    ("FRA", "Frankfurt Airport", "Frankfurt", "Germany", "Europe/Berlin", 50.0379, 8.5622),
    ("MUC", "Munich Airport", "Munich", "Germany", "Europe/Berlin", 48.3538, 11.7861),
    ("WAW", "Warsaw Chopin Airport", "Warsaw", "Poland", "Europe/Warsaw", 52.1657, 20.9671),
    ("ZRH", "Zurich Airport", "Zurich", "Switzerland", "Europe/Zurich", 47.4582, 8.5555),
)
# Demo routes (origin, destination), used round-robin.
ROUTES = (("GDN", "FRA"), ("FRA", "GDN"), ("GDN", "MUC"), ("MUC", "GDN"), ("WAW", "FRA"), ("ZRH", "MUC"))
# The demo data's defining cycles, so the generated data equals
# the reference demo data (720 flights → 142 delayed, 8 cancelled):
# cancelled when i % 97 == 0; delayed when i % 10 is 0 or 1; delayed flights
# are 18 + (i * 7) % 73 minutes late, others by ON_TIME_DELAYS[i % 5];
# flights every 2 hours; events 14 h / 2 h before, 5 / 10 min after departure.
ON_TIME_DELAYS = (0, 4, 7, 9, 12)

UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _utc(epoch_seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch_seconds), UTC_FORMAT)


def _pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % F.lit(len(values)) + 1).cast("int"))


def _flight_rows(spark: SparkSession, flight_count: int) -> DataFrame:
    i = F.col("id")
    status = (
        F.when(i % 97 == 0, F.lit("cancelled"))
        .when((i % 10 == 0) | (i % 10 == 1), F.lit("delayed"))
        .otherwise(F.lit("departed"))
    )
    delay = F.when(status == F.lit("delayed"), F.lit(18) + (i * 7) % 73).otherwise(_pick(ON_TIME_DELAYS, i))
    scheduled = F.lit(DEMO_START_EPOCH) + i * 7200
    actual = F.when(status == F.lit("cancelled"), scheduled).otherwise(scheduled + delay * 60)
    number = F.concat(F.lit("LH"), (F.lit(1000) + i % 9000).cast("string"))
    return spark.range(flight_count).select(
        i.alias("idx"),
        F.format_string(
            "%s-%s-%04d", number, F.date_format(F.timestamp_seconds(scheduled), "yyyy-MM-dd"), i
        ).alias("flight_id"),
        number.alias("flight_number"),
        _pick(tuple(o for o, _ in ROUTES), i).alias("origin_airport"),
        _pick(tuple(d for _, d in ROUTES), i).alias("destination_airport"),
        scheduled.alias("_sched"),
        _utc(scheduled).alias("scheduled_departure_utc"),
        _utc(actual).alias("actual_departure_utc"),
        status.alias("status"),
    )


def flights(spark: SparkSession, flight_count: int = DEFAULT_FLIGHT_COUNT) -> DataFrame:
    rows = _flight_rows(spark, flight_count)
    return rows.select(*contracts.field_names(contracts.FLIGHTS))


def airports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(AIRPORTS), contracts.spark_schema(contracts.AIRPORTS))


def weather(spark: SparkSession) -> DataFrame:
    n_air = len(AIRPORTS)
    k = F.col("id")
    day, ai = (k / n_air).cast("bigint"), k % n_air
    observed = F.lit(DEMO_START_EPOCH) + day * 86400
    return spark.range(WEATHER_DAYS * n_air).select(
        _pick(tuple(a[0] for a in AIRPORTS), ai).alias("airport_code"),
        _utc(observed).alias("observed_at_utc"),
        F.round(F.lit(9.0) + ai * F.lit(1.8) + day % 9, 1).alias("temperature_c"),
        F.round(F.lit(8.0) + (day * 3 + ai * 5) % 28, 1).alias("wind_speed_kmh"),
        F.round(((day + ai) % 6) * F.lit(0.4), 1).alias("precipitation_mm"),
    )


def passenger_events(spark: SparkSession, flight_count: int = DEFAULT_FLIGHT_COUNT) -> DataFrame:
    f = _flight_rows(spark, flight_count)
    i, s = F.col("idx"), F.col("_sched")

    def event(cond: Column, kind: str, event_type: str, offset_s: int, channel: str) -> Column:
        return F.when(
            cond,
            F.struct(
                F.format_string(f"evt-{kind}-%04d", i).alias("event_id"),
                F.col("flight_id").alias("flight_id"),
                F.lit(event_type).alias("event_type"),
                _utc(s + offset_s).alias("event_timestamp_utc"),
                F.lit(channel).alias("channel"),
            ),
        )

    candidates = F.array(
        event(i % 3 == 0, "checkin", "mobile_check_in", -14 * 3600, "mobile_app"),
        event(i % 5 == 0, "boarding", "boarding_pass_viewed", -2 * 3600, "web"),
        event(F.col("status") == "delayed", "delay", "delay_notification_sent", 5 * 60, "mobile_app"),
        event(F.col("status") == "cancelled", "rebooking", "rebooking_offer_viewed", 10 * 60, "email"),
    )
    return f.select(F.explode(F.array_compact(candidates)).alias("e")).select("e.*")


def raw_sources(spark: SparkSession, flight_count: int = DEFAULT_FLIGHT_COUNT) -> dict[str, DataFrame]:
    """All four sources as raw JSON text records (``value``)."""
    frames = {
        contracts.FLIGHTS: flights(spark, flight_count),
        contracts.AIRPORTS: airports(spark),
        contracts.WEATHER: weather(spark),
        contracts.PASSENGER_EVENTS: passenger_events(spark, flight_count),
    }
    return {name: df.select(F.to_json(F.struct(*df.columns)).alias("value")) for name, df in frames.items()}
