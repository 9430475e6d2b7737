"""Map the supplied TPC-H-like tables onto the four airline sources.

The derivations are plain column expressions and joins, so every source
grows with the input tables. The same derivations are written in SQL in
``aerolith.plans.oracle`` for the DuckDB cross-check.

* airports  ← nation (+ region name as country); code ``A`` + two letters.
* flights   ← lineitem ⋈ orders ⋈ supplier ⋈ customer; flight id =
  ``orderkey-linenumber`` (naturally duplicated in the input), origin =
  supplier nation, destination = customer nation.
* weather   ← events; airport from ``user_id % 23`` (two airports get none).
* passenger events ← events; flight id from ``event_id`` modulo the largest
  order key, so they reach flights of every key (many dangle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith import contracts
from aerolith.operators.dedupe import deduplicate
from aerolith.operators.silver import clean_flights, clean_source
from aerolith.session import spread

# Fixed values of the mapping (mirrored in the oracle SQL).
EPOCH_2024 = 1704067200  # 2024-01-01T00:00:00Z in seconds
SCHEDULE_SPAN_MINUTES = 43200  # 30 days
WEATHER_AIRPORTS = 23
EVENT_FLIGHT_STEP = 7919  # a prime: consecutive events reach flights over the whole key range
EVENT_TYPE_MAP = (
    ("click", "mobile_check_in"),
    ("view", "boarding_pass_viewed"),
    ("error", "delay_notification_sent"),
    ("purchase", "rebooking_offer_viewed"),
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def airport_code(key: str | Column) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(
        F.lit("A"),
        F.char(F.lit(65) + F.floor(k / F.lit(5))),
        F.char(F.lit(65) + k % F.lit(5)),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    k = F.col("n_nationkey").cast("double")
    # Both are file scans: Spark's file-size statistics decide the broadcast.
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        airport_code("n_nationkey").alias("airport_code"),
        F.col("n_name").alias("airport_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.lit("UTC").alias("timezone"),
        (k * F.lit(3.5) - F.lit(40.0)).alias("latitude_deg"),
        (k * F.lit(7.0) - F.lit(80.0)).alias("longitude_deg"),
    )


# Time zones by remainder of the nation key; the third and fourth are no zone names.
ZONES = ("Europe/Warsaw", "America/New_York", "Mars/Olympus", "europe/warsaw", None)


def airports_with_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports in zones that are valid, wrong, in wrong case or missing."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey")
    listed = F.array(*[F.lit(z) for z in ZONES])
    zone = F.element_at(listed, (F.col("n_nationkey") % len(ZONES) + 1).cast("int"))
    keyed = nation.select(airport_code("n_nationkey").alias("airport_code"), zone.alias("timezone"))
    return airports(spark, sf_dir).drop("timezone").join(keyed, "airport_code")


def _scheduled_seconds() -> Column:
    minutes = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 61) % F.lit(SCHEDULE_SPAN_MINUTES)
    return F.lit(EPOCH_2024) + minutes * F.lit(60)


def _actual_departure() -> Column:
    actual_s = _scheduled_seconds() + (F.col("l_quantity").cast("bigint") - 20) * 60 + F.col("l_partkey") % 60
    return F.when(F.col("l_tax") == F.lit(0.0), F.lit(None).cast("timestamp")).otherwise(F.timestamp_seconds(actual_s))


def _status() -> Column:
    return (
        F.when(F.col("l_discount") >= F.lit(0.1), F.lit("CANCELLED"))
        .when(F.col("l_tax") == F.lit(0.0), F.lit("scheduled"))
        .when(F.col("l_quantity") > F.lit(35.0), F.lit("DELAYED"))
        .otherwise(F.lit("departed"))
    )


def _flight_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The columns flights are made of: lineitem, orders, supplier, customer."""
    return (
        read_table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_discount"
        ),
        read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
        read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
        read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
    )


def _bronze_shape(
    joined: DataFrame, origin: Column, destination: Column, actual: Column, status: Column, extra: tuple[str, ...]
) -> DataFrame:
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("flight_id"),
        F.concat(F.lit("FL"), F.col("l_orderkey").cast("string")).alias("flight_number"),
        origin.alias("origin_airport"),
        destination.alias("destination_airport"),
        F.timestamp_seconds(_scheduled_seconds()).alias("scheduled_departure_utc"),
        actual.alias("actual_departure_utc"),
        status.alias("status"),
        *extra,
    )


def bronze_flights(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = (), spread_out: bool = False) -> DataFrame:
    """Flights in bronze shape; ``extra`` carries lineage columns along.
    ``spread_out`` deals a small lineitem over all cores, for costly expressions
    that follow."""
    li, orders, supplier, customer = _flight_sources(spark, sf_dir)
    if spread_out:
        li = spread(li)
    joined = (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
    )
    origin, destination = airport_code("s_nationkey"), airport_code("c_nationkey")
    return _bronze_shape(joined, origin, destination, _actual_departure(), _status(), extra)


def bronze_flights_once(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """What ``deduplicate`` keeps of ``bronze_flights``, chosen before lines and
    orders are joined, so that flights are shuffled as few narrow columns.

    Every line of a flight id meets every order row of its key. Of the survivor
    order's columns, number and schedule are the same for a flight id; origin,
    actual time and status are the line's, destination and order status the
    order's. The first of all pairs is therefore the first line with the first
    order, each by its own columns in that order. Both choices forward one row
    per key and map task; a hot order is left to the join, which AQE splits."""
    li, orders, supplier, customer = _flight_sources(spark, sf_dir)
    lines = li.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "l_orderkey",
        "l_linenumber",
        airport_code("s_nationkey").alias("origin_airport"),
        _actual_departure().alias("actual_departure_utc"),
        _status().alias("status"),
    )
    booked = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", airport_code("c_nationkey").alias("destination_airport"), "o_orderstatus"
    )
    joined = deduplicate(lines, ["l_orderkey", "l_linenumber"]).join(
        deduplicate(booked, ["o_orderkey"]), F.col("l_orderkey") == F.col("o_orderkey")
    )
    held = (F.col(c) for c in ("origin_airport", "destination_airport", "actual_departure_utc", "status"))
    return _bronze_shape(joined, *held, extra)


def weather(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = (), spread_out: bool = False) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    if spread_out:
        ev = spread(ev)
    return ev.select(
        airport_code(F.col("user_id") % F.lit(WEATHER_AIRPORTS)).alias("airport_code"),
        F.col("ts").cast("timestamp").alias("observed_at_utc"),
        (F.col("value") / F.lit(10.0) - F.lit(20.0)).alias("temperature_c"),
        (F.col("value") / F.lit(5.0)).alias("wind_speed_kmh"),
        (F.col("value") / F.lit(50.0)).alias("precipitation_mm"),
        *extra,
    )


def passenger_events(spark: SparkSession, sf_dir: str, extra: tuple[Column, ...] = (), spread_out: bool = False) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    if spread_out:
        ev = spread(ev)
    etype = F.col("event_type")
    mapped = None
    for raw, target in EVENT_TYPE_MAP:
        mapped = (F.when if mapped is None else mapped.when)(etype == F.lit(raw), F.lit(target))
    mapped = mapped.otherwise(etype)
    channels = F.array(*[F.lit(c) for c in contracts.CHANNELS])
    last_order = read_table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).scalar()
    return ev.select(
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("event_id"),
        F.concat_ws(
            "-",
            ((F.col("event_id") * EVENT_FLIGHT_STEP) % (last_order + 1)).cast("string"),
            (F.lit(1) + F.col("event_id") % 7).cast("string"),
        ).alias("flight_id"),
        mapped.alias("event_type"),
        F.col("ts").cast("timestamp").alias("event_timestamp_utc"),
        F.element_at(channels, (F.col("user_id") % F.lit(len(contracts.CHANNELS)) + 1).cast("int")).alias("channel"),
        *extra,
    )


# Silver-shaped frames (deduplicated, derived columns) over the same mapping.


def silver_flights(spark: SparkSession, sf_dir: str, missing_delay: str = "zero", cancelled_delay: str = "keep") -> DataFrame:
    return clean_flights(bronze_flights(spark, sf_dir), missing_delay=missing_delay, cancelled_delay=cancelled_delay)


def silver_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_source(contracts.AIRPORTS, airports(spark, sf_dir))


def silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_source(contracts.WEATHER, weather(spark, sf_dir))


def silver_passenger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_source(contracts.PASSENGER_EVENTS, passenger_events(spark, sf_dir))


# Raw JSON records (the landing format validation reads) over the same mapping.
# Every source breaks every rule that applies to it, on rows picked by the
# remainder of a key; some rows carry odd but valid spellings.

UTC_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
UTC_TEXT_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
FLIGHT_CASES, AIRPORT_CASES, WEATHER_CASES, EVENT_CASES = 29, 12, 31, 37


def _json(text: str) -> Column:
    """A JSON value as VARIANT; ``null`` stays a present, empty key."""
    return F.parse_json(F.lit(text))


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("variant")


def _cases(key: Column, n: int, value: Column, cases: dict[int, Column | None]) -> Column:
    """``value``, or for some remainders of ``key`` another one (None: absent)."""
    out = F
    for remainder, other in cases.items():
        out = out.when(key % n == remainder, F.lit(None).cast("variant") if other is None else other)
    return out.otherwise(value)


def _raw(df: DataFrame, ref: Column, columns: dict[str, Column]) -> DataFrame:
    """JSON text per record; a null column is an absent key."""
    value = F.to_json(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select(value.alias("value"), ref.cast("string").alias("_record_ref"))


def _raw_flights(spark: SparkSession, sf_dir: str, distinct: bool = False) -> DataFrame:
    extra = ("o_orderstatus", "l_orderkey", "l_linenumber")
    if distinct:
        f = bronze_flights_once(spark, sf_dir, extra)
    else:
        f = bronze_flights(spark, sf_dir, extra, spread_out=True)
    key, n = F.col("l_orderkey") * 7 + F.col("l_linenumber"), FLIGHT_CASES
    departs = F.col("scheduled_departure_utc")
    return _raw(
        f,
        F.col("flight_id"),
        {
            "flight_id": _text("flight_id"),
            "flight_number": F.when(F.col("o_orderstatus") != F.lit("P"), _cases(key, n, _text("flight_number"), {1: _json('""')})),
            "origin_airport": _cases(key, n, _text("origin_airport"), {2: _json('"  "'), 3: _text(F.lower("origin_airport"))}),
            "destination_airport": _cases(
                key, n, _text("destination_airport"), {4: _text(F.concat("destination_airport", F.lit("X"))), 5: None}
            ),
            "scheduled_departure_utc": _cases(
                key,
                n,
                _text(F.date_format(departs, UTC_TEXT)),
                {
                    6: _json('"soon"'),
                    7: _text(F.date_format(departs, "yyyy-MM-dd'Z'")),
                    8: _text(F.date_format(departs, "yyyyMMdd'T'HHmmss'Z'")),
                    9: _text(F.date_format(departs, "yyyy-MM-dd'T'HH:mm:ss'+02:00'")),
                },
            ),
            "actual_departure_utc": _cases(
                key, n, _text(F.date_format("actual_departure_utc", UTC_TEXT)), {10: _json('""'), 11: _json('"2024-13-01T00:00:00Z"')}
            ),
            "status": _cases(key, n, _text("status"), {5: None, 12: _json("null"), 13: _json("7")}),
        },
    )


def _raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey")
    a = airports(spark, sf_dir).join(nation.withColumn("airport_code", airport_code("n_nationkey")), "airport_code")
    key, n = F.col("n_nationkey"), AIRPORT_CASES
    return _raw(
        a,
        F.col("airport_code"),
        {
            "airport_code": _cases(key, n, _text("airport_code"), {3: _text(F.lower("airport_code")), 9: _json('"A1C"')}),
            "airport_name": _cases(key, n, _text("airport_name"), {2: _json('" "')}),
            "city": _cases(key, n, _text("city"), {1: None}),
            "country": _cases(key, n, _text("country"), {1: None, 7: _json("null")}),
            "timezone": _text("timezone"),
            "latitude_deg": _cases(key, n, _text("latitude_deg"), {4: _json("95"), 6: _json("null")}),
            "longitude_deg": _cases(key, n, _text("longitude_deg"), {5: _json('"west"'), 8: _json('" 12.5 "')}),
        },
    )


def _raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = weather(spark, sf_dir, extra=("event_id",), spread_out=True)
    key, n = F.col("event_id"), WEATHER_CASES
    observed = _text(F.date_format("observed_at_utc", UTC_TEXT_MICROS))
    return _raw(
        w,
        key,
        {
            "airport_code": _cases(key, n, _text("airport_code"), {1: _text(F.lower("airport_code"))}),
            "observed_at_utc": _cases(key, n, observed, {5: _json('"noon"'), 6: _json('""')}),
            "temperature_c": _cases(key, n, _text("temperature_c"), {2: _json("120"), 7: _json("null")}),
            "wind_speed_kmh": _cases(key, n, _text("wind_speed_kmh"), {3: _json('"calm"'), 8: _json("true"), 10: _json("-1")}),
            "precipitation_mm": _cases(key, n, _text("precipitation_mm"), {4: None, 9: _json('"0.5"')}),
        },
    )


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = passenger_events(spark, sf_dir, extra=(F.col("event_id").alias("key"),), spread_out=True)
    key, n = F.col("key"), EVENT_CASES
    at = F.col("event_timestamp_utc")
    return _raw(
        e,
        F.col("event_id"),
        {
            "event_id": _text("event_id"),
            "flight_id": _cases(key, n, _text("flight_id"), {3: None}),
            "event_type": _cases(key, n, _text("event_type"), {6: _json('""')}),
            "event_timestamp_utc": _cases(
                key,
                n,
                _text(F.date_format(at, UTC_TEXT_MICROS)),
                {2: _json('"later"'), 7: _text(F.date_format(at, "yyyy-MM-dd'T'HH'Z'"))},
            ),
            "channel": _cases(key, n, _text("channel"), {1: _json('"fax"'), 5: _json("null")}),
        },
    )


def raw_records(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Raw records of ``source`` (``value``, ``_record_ref``). Flights of
    orders in status ``P`` (pending) arrive without a flight number, and raw
    statuses keep the upper-case spellings."""
    build = {
        contracts.FLIGHTS: _raw_flights,
        contracts.AIRPORTS: _raw_airports,
        contracts.WEATHER: _raw_weather,
        contracts.PASSENGER_EVENTS: _raw_events,
    }
    if source not in build:
        raise ValueError(f"Unsupported source: {source}")
    return build[source](spark, sf_dir)


def landed_once(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw records of all sources, one per flight id: which of several a build
    keeps would depend on the files they land in."""
    records = {source: raw_records(spark, sf_dir, source) for source in contracts.SOURCES}
    return records | {contracts.FLIGHTS: _raw_flights(spark, sf_dir, distinct=True)}


# Landed public-source texts over the same tables.


def airport_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an airport master CSV (``landed.AIRPORT_CSV_COLUMNS``): names
    hold separators and doubled quotes, codes vary in case and spaces, some
    codes and coordinates are blank or mistyped."""
    n = read_table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    name = F.concat(F.lit('"The ""Big"" '), F.col("n_name"), F.lit(', Airport"'))
    latitude = F.when(k % 7 == 1, F.lit("")).when(k % 7 == 2, F.lit("north")).otherwise(F.concat(F.lit(" "), (k - 12).cast("string")))
    code = F.when(k % 9 == 4, F.lit(" ")).otherwise(F.concat(F.lit(" "), F.lower(airport_code("n_nationkey"))))
    fields = [name, latitude, (k * 2).cast("string"), F.concat(F.lit(" C"), F.col("n_regionkey").cast("string")), F.col("n_name"), code]
    return n.select(F.concat_ws(",", *fields).alias("value"))


def hourly_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather payloads, one per four consecutive events: the last
    array may be short, values may be text or null, some arrays are no lists,
    some payloads are empty."""
    e = read_table(spark, sf_dir, "events").withColumn("group", F.floor(F.col("event_id") / 4))
    k = F.col("event_id")
    odd = F.when(k % 11 == 3, F.lit("null")).when(k % 11 == 5, F.lit('"n/a"'))
    time = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm")
    item = F.struct(
        k.alias("k"),
        F.concat(F.lit('"'), time, F.lit('"')).alias("time"),
        odd.when(k % 11 == 7, F.concat(F.lit('"'), k % 40, F.lit('"'))).otherwise((k % 50).cast("string")).alias("temperature"),
        (k % 90).cast("string").alias("wind"),
        (k % 20).cast("string").alias("rain"),
    )
    g = e.groupBy("group").agg(F.array_sort(F.collect_list(item)).alias("items"), F.min("user_id").alias("user_id"))

    def listed(name: str) -> Column:
        return F.transform("items", lambda x: x[name])

    def array(items: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))

    wind = F.when(F.col("group") % 5 == 2, F.slice(listed("wind"), 1, 2)).otherwise(listed("wind"))
    payload = F.concat(
        F.lit('{"hourly":{"time":'),
        F.when(F.col("group") % 13 == 4, F.lit('"none"')).otherwise(array(listed("time"))),
        F.lit(',"temperature_2m":'),
        array(listed("temperature")),
        F.lit(',"precipitation":'),
        array(listed("rain")),
        F.lit(',"wind_speed_10m":'),
        array(wind),
        F.lit("}}"),
    )
    payload = F.when(F.col("group") % 17 == 6, F.lit("{}")).otherwise(payload)
    return g.select(airport_code(F.col("user_id") % WEATHER_AIRPORTS).alias("airport_code"), payload.alias("payload"))
