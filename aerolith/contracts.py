"""Source contracts: one declarative table yields the Spark schema, the
required-field list, the vocabularies and the numeric ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

FLIGHTS = "flights"
AIRPORTS = "airports"
WEATHER = "weather"
PASSENGER_EVENTS = "passenger_events"
SOURCES = (FLIGHTS, AIRPORTS, WEATHER, PASSENGER_EVENTS)


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str  # "string" | "timestamp" | "float"
    required: bool = True


# Field lists of the four source contracts, in contract order.
CONTRACTS: dict[str, tuple[Field, ...]] = {
    FLIGHTS: (
        Field("flight_id", "string"),
        Field("flight_number", "string"),
        Field("origin_airport", "string"),
        Field("destination_airport", "string"),
        Field("scheduled_departure_utc", "timestamp"),
        Field("actual_departure_utc", "timestamp", required=False),
        Field("status", "string"),
    ),
    AIRPORTS: (
        Field("airport_code", "string"),
        Field("airport_name", "string"),
        Field("city", "string"),
        Field("country", "string"),
        Field("timezone", "string", required=False),
        Field("latitude_deg", "float", required=False),
        Field("longitude_deg", "float", required=False),
    ),
    WEATHER: (
        Field("airport_code", "string"),
        Field("observed_at_utc", "timestamp"),
        Field("temperature_c", "float"),
        Field("wind_speed_kmh", "float"),
        Field("precipitation_mm", "float"),
    ),
    PASSENGER_EVENTS: (
        Field("event_id", "string"),
        Field("flight_id", "string"),
        Field("event_type", "string"),
        Field("event_timestamp_utc", "timestamp"),
        Field("channel", "string"),
    ),
}

# Controlled vocabularies.
FLIGHT_STATUSES = ("scheduled", "departed", "delayed", "cancelled")
EVENT_TYPES = (
    "mobile_check_in",
    "delay_notification_sent",
    "boarding_pass_viewed",
    "rebooking_offer_viewed",
)
CHANNELS = ("mobile_app", "web", "email", "sms")

VOCABULARIES: dict[str, dict[str, tuple[str, ...]]] = {
    FLIGHTS: {"status": FLIGHT_STATUSES},
    PASSENGER_EVENTS: {"event_type": EVENT_TYPES, "channel": CHANNELS},
}

# Inclusive numeric ranges per source.
NUMERIC_RANGES: dict[str, dict[str, tuple[float, float]]] = {
    AIRPORTS: {"latitude_deg": (-90.0, 90.0), "longitude_deg": (-180.0, 180.0)},
    WEATHER: {
        "temperature_c": (-80.0, 60.0),
        "wind_speed_kmh": (0.0, 400.0),
        "precipitation_mm": (0.0, 500.0),
    },
}

# Fields that must look like an IATA code, per source.
CODE_FIELDS: dict[str, tuple[str, ...]] = {
    FLIGHTS: ("origin_airport", "destination_airport"),
    AIRPORTS: ("airport_code",),
    WEATHER: ("airport_code",),
}

# Business keys used by the silver deduplication.
BUSINESS_KEYS: dict[str, tuple[str, ...]] = {
    FLIGHTS: ("flight_id",),
    AIRPORTS: ("airport_code",),
    WEATHER: ("airport_code", "observed_at_utc"),
    PASSENGER_EVENTS: ("event_id",),
}

_SPARK_TYPES = {"string": T.StringType(), "timestamp": T.TimestampType(), "float": T.DoubleType()}


def fields(source: str) -> tuple[Field, ...]:
    try:
        return CONTRACTS[source]
    except KeyError:
        raise ValueError(f"Unsupported source: {source}") from None


def field_names(source: str) -> list[str]:
    return [f.name for f in fields(source)]


def required_fields(source: str) -> list[str]:
    return sorted(f.name for f in fields(source) if f.required)


def spark_schema(source: str) -> T.StructType:
    """Contract → StructType. Every field is nullable: required-ness is
    enforced by the validation rules, not by the reader."""
    return T.StructType([T.StructField(f.name, _SPARK_TYPES[f.dtype], True) for f in fields(source)])
