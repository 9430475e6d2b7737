"""Landed public-source files as Spark jobs.

The HTTP fetch itself is out of scope; these read the landed payloads:
an airport master CSV and hourly weather JSON payloads.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.sources.raw import require_path

# The batch pipeline's own airport selection (IATA codes), to pass as ``airport_codes``.
BATCH_AIRPORT_CODES = (
    "GDN", "FRA", "MUC", "ZRH", "VIE", "BRU", "HAM", "DUS", "BER",
    "CPH", "WAW", "KRK", "AMS", "LHR", "CDG", "MAD", "BCN", "FCO",
)

_WS = r"(?U)\A\s+|\s+\z"


def _strip(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), _WS, "")


def _to_double(c: Column) -> Column:
    text = F.regexp_replace(c, _WS, "")
    return F.when(c.isNull() | (text == F.lit("")), F.lit(None).cast("double")).otherwise(text.try_cast("double"))


# The columns used, as named in the header of the airport master file.
AIRPORT_CSV_COLUMNS = ("name", "latitude_deg", "longitude_deg", "iso_country", "municipality", "iata_code")
# A quote inside a quoted value is written twice.
CSV_OPTIONS = {"quote": '"', "escape": '"'}


def airports_of(raw: DataFrame, airport_codes: Iterable[str] | None = None) -> DataFrame:
    """Airports (sorted by code) from the text columns of the airport
    master, all with a code or only those listed. Blank coordinates are null;
    non-numeric ones are null too (documented narrowing: the batch parser
    raised)."""
    code = F.upper(_strip(F.col("iata_code")))
    chosen = raw.where(code != F.lit(""))
    if airport_codes is not None:
        chosen = chosen.where(code.isin(sorted({c.upper() for c in airport_codes})))
    return chosen.select(
        code.alias("airport_code"),
        _strip(F.col("name")).alias("airport_name"),
        _strip(F.col("municipality")).alias("city"),
        _strip(F.col("iso_country")).alias("country"),
        _to_double(F.col("latitude_deg")).alias("latitude_deg"),
        _to_double(F.col("longitude_deg")).alias("longitude_deg"),
    ).orderBy("airport_code")


def read_airport_csv(spark: SparkSession, path: str, airport_codes: Iterable[str] | None = None) -> DataFrame:
    """S8 from an airport master CSV file with a header row. Quoted values may
    hold separators, doubled quotes and line breaks."""
    require_path(spark, path, "landed airports")
    return airports_of(spark.read.options(header=True, multiLine=True, **CSV_OPTIONS).csv(path), airport_codes)


def parse_airport_csv(lines: DataFrame, columns: Iterable[str] = AIRPORT_CSV_COLUMNS, airport_codes: Iterable[str] | None = None) -> DataFrame:
    """S8 from a DataFrame of CSV lines (``value``) whose columns are given."""
    schema = ", ".join(f"{c} string" for c in columns)
    return airports_of(lines.select(F.from_csv("value", schema, CSV_OPTIONS).alias("r")).select("r.*"), airport_codes)


def utc_text(value: Column) -> Column:
    """Keep text ending in ``Z`` or ``+00:00``; 16-character
    ``yyyy-MM-ddTHH:mm`` gets ``:00Z``; anything else gets ``Z``."""
    v = value.cast("string")
    return (
        F.when(v.endswith("Z") | v.endswith("+00:00"), v)
        .when(F.length(v) == 16, F.concat(v, F.lit(":00Z")))
        .otherwise(F.concat(v, F.lit("Z")))
    )


# Values stay text: what is not a number is for the contract (V8) to report.
_HOURLY_FIELDS = ("time", "temperature_2m", "precipitation", "wind_speed_10m")


def explode_hourly_weather(payloads: DataFrame, code_col: str = "airport_code", payload_col: str = "payload") -> DataFrame:
    """One weather record per hour from (airport code, JSON payload)
    rows, its values as the payload's text. Parallel arrays are cut to the
    shortest one; an array that is not a list counts as empty; a payload
    without ``hourly`` yields no rows.

    ``arrays_zip`` alone pads to the longest array, so every array is sliced
    to the common length first."""
    # Each array is parsed on its own, so that one odd array costs no other.
    arrays = [
        F.from_json(F.get_json_object(payload_col, f"$.hourly.{name}"), "array<string>").alias(name) for name in _HOURLY_FIELDS
    ]
    parsed = payloads.select(F.upper(_strip(F.col(code_col))).alias("airport_code"), *arrays)
    n = F.greatest(F.least(*[F.coalesce(F.size(name), F.lit(0)) for name in _HOURLY_FIELDS]), F.lit(0))
    zipped = F.arrays_zip(*[F.slice(name, F.lit(1), n).alias(name) for name in _HOURLY_FIELDS])
    return parsed.select("airport_code", F.inline(zipped).alias(*_HOURLY_FIELDS)).select(
        "airport_code",
        utc_text(F.col("time")).alias("observed_at_utc"),
        F.col("temperature_2m").alias("temperature_c"),
        F.col("wind_speed_10m").alias("wind_speed_kmh"),
        F.col("precipitation").alias("precipitation_mm"),
    )


def read_hourly_weather(spark: SparkSession, path: str) -> DataFrame:
    """Landed hourly payloads as JSON Lines of ``{"airport_code": …,
    "payload": {…}}``; the payload is kept as raw text for S9."""
    require_path(spark, path, "landed weather")
    text = spark.read.text(path)
    return explode_hourly_weather(
        text.select(
            F.get_json_object("value", "$.airport_code").alias("airport_code"),
            F.get_json_object("value", "$.payload").alias("payload"),
        )
    )


def weather_airports(airports: DataFrame, max_airports: int | None = None) -> DataFrame:
    """The airports with a code and both coordinates. ``max_airports``
    first takes that many by code, as the batch extractor does to limit its
    requests; skipped airports are not replaced. Landed payloads need no limit."""
    first = airports if max_airports is None else airports.orderBy("airport_code").limit(max_airports)
    code = F.upper(_strip(F.col("airport_code")))
    return first.where(
        (code != F.lit("")) & F.col("latitude_deg").isNotNull() & F.col("longitude_deg").isNotNull()
    ).withColumn("airport_code", code)
