"""Sources (S1, S6–S17) and the jobs (K1–K4) end to end in a scratch folder."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aerolith import contracts
from aerolith.plans import jobs
from aerolith.plans.reports import REPORTS, run_report
from aerolith.sources import catalog, landed, raw, synthetic
from aerolith.sources.raw import read_json_array_file, records_frame

CSV_HEADER = "iata_code,latitude_deg,name,longitude_deg,municipality,iso_country,scheduled_service"
CSV_LINES = [
    'TRD,63.4578,"Værnes ""VAE"", Trondheim",10.924,Stjørdal,NO,yes',
    " bgo ,,Flesland,5.218,Bergen,NO,yes",
    'SVG,north,"Sola\nTerminal 2",5.6378, Stavanger ,NO,yes',
    ",1,No code,2,Nowhere,NO,no",
    "KRS,58.2042,Kjevik,8.0853,Kristiansand,NO,yes",
]


def write(folder, name, text):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.fixture()
def airport_csv(scratch):
    return write(scratch, "airports.csv", "\n".join([CSV_HEADER, *CSV_LINES]) + "\n")


def test_airport_csv_keeps_all_airports_and_their_quoting(spark, airport_csv):
    rows = [tuple(r) for r in landed.read_airport_csv(spark, airport_csv).collect()]
    assert rows == [
        ("BGO", "Flesland", "Bergen", "NO", None, 5.218),
        ("KRS", "Kjevik", "Kristiansand", "NO", 58.2042, 8.0853),
        ("SVG", "Sola\nTerminal 2", "Stavanger", "NO", None, 5.6378),
        ("TRD", 'Værnes "VAE", Trondheim', "Stjørdal", "NO", 63.4578, 10.924),
    ]
    assert [r.airport_code for r in landed.read_airport_csv(spark, airport_csv, ("trd", "XXX")).collect()] == ["TRD"]
    lines = spark.createDataFrame([('"A ""b"", c",1,2,NO,Town,aaa',)], "value string")
    assert tuple(landed.parse_airport_csv(lines).first()) == ("AAA", 'A "b", c', "Town", "NO", 1.0, 2.0)


def hourly(**arrays):
    base = {"time": ["2025-11-03T00:00", "2025-11-03T01:00"], "temperature_2m": [1.5, 2], "precipitation": [0, 0.25], "wind_speed_10m": [9, 8.75]}
    return json.dumps({"hourly": {**base, **arrays}})


def test_hourly_payloads_lose_no_airport_to_an_odd_value(spark):
    payloads = [
        ("trd", hourly()),
        ("BGO", hourly(temperature_2m=["12.5", "n/a"], precipitation=[None, True])),
        ("SVG", hourly(wind_speed_10m=[3])),
        ("KRS", hourly(time="2025-11-03T00:00")),
        ("OSL", "{}"),
        ("ARN", "not json"),
        ("CPH", None),
    ]
    out = landed.explode_hourly_weather(spark.createDataFrame(payloads, "airport_code string, payload string"))
    rows = sorted(tuple(r) for r in out.collect())
    assert [r[:3] for r in rows] == [
        ("BGO", "2025-11-03T00:00:00Z", "12.5"),
        ("BGO", "2025-11-03T01:00:00Z", "n/a"),
        ("SVG", "2025-11-03T00:00:00Z", "1.5"),
        ("TRD", "2025-11-03T00:00:00Z", "1.5"),
        ("TRD", "2025-11-03T01:00:00Z", "2"),
    ]
    assert rows[0][4] is None and rows[-1][3:] == ("8.75", "0.25")


def test_utc_text(spark):
    cases = {"2025-11-03T00:00": "2025-11-03T00:00:00Z", "a Z": "a Z", "x+00:00": "x+00:00", "2025-11-03T00:00:01": "2025-11-03T00:00:01Z"}
    frame = spark.createDataFrame([(c,) for c in cases], "t string")
    assert [r[0] for r in frame.select(landed.utc_text(F.col("t"))).collect()] == list(cases.values())


def test_weather_airports_are_all_unless_limited(spark):
    rows = [("CCC", 5.0, 6.0), ("AAA", None, 2.0), (" bbb", 3.0, 4.0), ("", 1.0, 1.0)]
    airports = spark.createDataFrame(rows, "airport_code string, latitude_deg double, longitude_deg double")
    assert sorted(r.airport_code for r in landed.weather_airports(airports).collect()) == ["BBB", "CCC"]
    # The limit comes first: what it skips is not replaced.
    assert [r.airport_code for r in landed.weather_airports(airports, 3).collect()] == ["BBB"]


def test_array_files_are_read_whole_or_not_at_all(spark, scratch):
    good = write(scratch, "good/a.json", json.dumps([{"flight_id": "x"}, {"flight_id": "y", "n": [1]}]))
    got = sorted((r._record_ref, json.loads(r.value)["flight_id"]) for r in read_json_array_file(spark, good).collect())
    assert got == [("0", "x"), ("1", "y")]
    for i, text in enumerate(['[{"flight_id": "x"}, {"fl', '{"flight_id": "x"}', "null", " "]):
        path = write(scratch, f"bad{i}/broken.json", text)
        with pytest.raises(PySparkException, match="broken.json"):
            read_json_array_file(spark, path).collect()


def test_synthetic_sources_have_the_generators_counts(spark):
    flights, events = synthetic.flights(spark), synthetic.passenger_events(spark)
    counts = {r.status: r["count"] for r in flights.groupBy("status").count().collect()}
    assert counts == {"delayed": 142, "cancelled": 8, "departed": 570}
    assert (synthetic.weather(spark).count(), events.count()) == (150, 534)
    assert events.join(flights, "flight_id", "left_anti").count() == 0


@pytest.fixture()
def built(spark, scratch):
    """All layers of the synthetic sources: ``name -> folder``."""
    at = {name: f"{scratch}/{name}" for name in ("raw", "bronze", "silver", "gold")}
    at["summary"] = jobs.ingest(at["raw"], spark=spark)
    at["bronze_rows"] = jobs.build_bronze(at["raw"], at["bronze"], spark=spark)
    jobs.build_silver(at["bronze"], at["silver"], spark=spark, partition_by_date=True)
    at["gold_rows"] = jobs.build_gold(at["silver"], at["gold"], spark=spark, partition_by_date=True)
    return at


def test_layers_round_trip(spark, built, scratch):
    sizes = {"flights": 720, "airports": 5, "weather": 150, "passenger_events": 534}
    assert {r["source"]: (r["accepted_records"], r["rejected_records"]) for r in built["summary"]} == {s: (n, 0) for s, n in sizes.items()}
    assert not any(r["synthetic_fallback"] for r in built["summary"])
    assert {r["source"]: r["row_count"] for r in built["bronze_rows"]} == sizes
    assert {r["table"]: r["row_count"] for r in built["gold_rows"]}["gold_flight_performance"] == 720
    assert jobs.total_records(built["bronze_rows"]) == sum(sizes.values())
    assert any(p.name.startswith("flight_date=") for p in Path(built["silver"], "flights").iterdir())
    tables = catalog.load_gold_tables(spark, built["gold"])
    for name, report in REPORTS.items():
        rows = run_report(name, spark.read.parquet(f"{built['gold']}/{report.table}")).collect()
        assert [r.report_position for r in rows] == list(range(1, len(rows) + 1)) and rows
    written = jobs.build_report(built["gold"], "route_delay", f"{scratch}/reports", spark=spark)
    assert written == [{"report": "route_delay", "row_count": 6}]
    profile = jobs.build_profile(built["silver"], built["gold"], f"{scratch}/profile", spark=spark)
    assert {r["table"]: r["row_count"] for r in profile} == {"quality_profile": 8, "dataset_inventory": 8}
    assert tables["route_performance"].count() == 6


def test_gold_flight_performance_keeps_the_load_columns_of_flights_and_airports(spark, built):
    technical = ["_bronze_loaded_at_utc", "_source_file", "_silver_loaded_at_utc"]
    airport = [*contracts.field_names("airports"), *technical]
    flight = [*contracts.field_names("flights"), "departure_delay_minutes", "is_cancelled", "is_delayed", *technical]
    measures = ["origin_temperature_c", "origin_wind_speed_kmh", "origin_precipitation_mm", "route", "_gold_loaded_at_utc"]
    wanted = [*flight, *(f"origin_{c}" for c in airport), *(f"destination_{c}" for c in airport), *measures]
    columns = spark.read.parquet(f"{built['gold']}/gold_flight_performance").columns
    assert len(wanted) == 38 and sorted(columns) == sorted([*wanted, "flight_date"])


ROW = {
    "flights": {"flight_id": "N1", "flight_number": "N 1", "origin_airport": "TRD", "destination_airport": "KRS",
                "scheduled_departure_utc": "2025-11-03Z", "actual_departure_utc": "2025-11-03T00:31:30Z", "status": "DEPARTED".lower()},
    "airports": {"airport_code": "TRD", "airport_name": "n", "city": "c", "country": "NO"},
    "weather": {"airport_code": "TRD", "observed_at_utc": "20251102T230000Z", "temperature_c": "1", "wind_speed_kmh": 2, "precipitation_mm": 0},
    "passenger_events": {"event_id": "e", "flight_id": "N1", "event_type": "mobile_check_in",
                         "event_timestamp_utc": "2025-11-02T20Z", "channel": "sms"},
}


def test_a_bad_record_empties_its_source_or_goes_to_quarantine(spark, scratch):
    records = {s: records_frame(spark, [r, r]) for s, r in ROW.items()}
    records["airports"] = records_frame(spark, [ROW["airports"], {"airport_code": "KRS", "airport_name": None, "city": "c", "country": ""}])
    for mode, kept in (("dataset", 0), ("record", 1)):
        out = f"{scratch}/{mode}"
        summary = {r["source"]: r for r in jobs.ingest(out, records=records, spark=spark, mode=mode)}
        assert (summary["airports"]["accepted_records"], summary["flights"]["accepted_records"]) == (kept, 2)
        assert spark.read.text(f"{out}/airports").count() == kept
    assert spark.read.parquet(f"{scratch}/record/_quarantine/airports").count() == 1
    assert {r.rule for r in spark.read.json(f"{scratch}/record/_errors/airports").collect()} == {"V2"}
    jobs.build_bronze(f"{scratch}/record", f"{scratch}/bronze", spark=spark)
    jobs.build_silver(f"{scratch}/bronze", f"{scratch}/silver", spark=spark)
    (flight,) = spark.read.parquet(f"{scratch}/silver/flights").collect()
    assert flight.departure_delay_minutes == 31.5 and flight.is_delayed


def test_records_are_written_small_and_in_files_of_bounded_length(spark, scratch, monkeypatch):
    monkeypatch.setattr(raw, "RECORDS_PER_FILE", 300)
    rows = [ROW["passenger_events"] | {"event_id": f"e{i}", "channel": "fax" if i % 4 == 0 else "sms"} for i in range(4000)]
    lines = [json.dumps(r) for r in rows]
    raw.write_lines(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(2), f"{scratch}/landing")
    writers = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    records = {"passenger_events": raw.read_json_lines(spark, f"{scratch}/landing")}
    (summary,) = jobs.ingest(f"{scratch}/raw", records=records, spark=spark, mode="record")
    assert (summary["accepted_records"], summary["rejected_records"], summary["error_count"]) == (3000, 1000, 1000)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == writers
    wanted = {"landing": 4000, "raw/passenger_events": 3000, "raw/_errors/passenger_events": 1000}
    for folder, n in wanted.items():
        files = [p for p in Path(scratch, folder).iterdir() if p.name.startswith("part-")]
        held = [len(gzip.decompress(p.read_bytes()).splitlines()) for p in files]
        assert sum(held) == n and max(held) <= 300 and len(held) >= n / 300
    assert {r.value for r in spark.read.text(f"{scratch}/raw/passenger_events").collect()} == {x for x in lines if "fax" not in x}
    assert spark.read.json(f"{scratch}/raw/_errors/passenger_events").where("rule = 'V3' AND field = 'channel'").count() == 1000
    # Everything written together takes less room than the records' text.
    assert sum(p.stat().st_size for p in Path(scratch).rglob("part-*")) < sum(map(len, lines))
    for kept in ("_validated/passenger_events", "_quarantine/passenger_events"):
        (file, *_) = Path(scratch, "raw", kept).rglob("part-*.parquet")
        assert ".zstd." in file.name


def test_landing_folder_of_array_files_and_bronze_of_them(spark, scratch):
    for source, record in ROW.items():
        write(scratch, f"landing/{source}/one.json", json.dumps([record, {}] if source == "weather" else [record]))
        write(scratch, f"arrays/{source}.json", json.dumps([record]))
    records = jobs.landed_records(spark, f"{scratch}/landing", "array")
    summary = {r["source"]: r for r in jobs.ingest(f"{scratch}/raw", records=records, spark=spark, mode="record")}
    assert summary["weather"]["rejected_records"] == 1
    (message,) = (r.message for r in spark.read.json(f"{scratch}/raw/_errors/weather").collect())
    assert message.startswith("weather[1] missing required field(s): airport_code, ")
    rows = jobs.build_bronze(f"{scratch}/arrays", f"{scratch}/bronze", spark=spark)
    assert {r["row_count"] for r in rows} == {1}
    with pytest.raises(ValueError):
        jobs.landed_records(spark, scratch, "xml")


def test_missing_or_broken_inputs_raise(spark, scratch, airport_csv):
    with pytest.raises(FileNotFoundError, match="raw"):
        jobs.build_bronze(f"{scratch}/none", f"{scratch}/out", spark=spark)
    with pytest.raises(ValueError):
        jobs.build_gold(scratch, scratch, spark=spark)
    with pytest.raises(ValueError):
        jobs.source_records(spark, airport_source="ftp")
    with pytest.raises(FileNotFoundError):
        jobs.source_records(spark, airport_source="csv", airport_csv=f"{scratch}/none.csv")
    for table in catalog.GOLD_TABLE_NAMES.values():
        write(scratch, f"gold/{table}/part-0.parquet", "this is no Parquet file")
    with pytest.raises(Exception, match="part-0.parquet"):
        catalog.load_dashboard_tables(spark, f"{scratch}/gold")


def test_synthetic_stand_ins_are_asked_for_and_reported(spark, scratch):
    options = {"airport_source": "csv", "airport_csv": f"{scratch}/none.csv", "allow_synthetic": True}
    summary = {r["source"]: r for r in jobs.ingest(f"{scratch}/raw", spark=spark, **options)}
    assert summary["airports"]["synthetic_fallback"] and not summary["weather"]["synthetic_fallback"]
    tables, demo = catalog.load_dashboard_tables(spark, f"{scratch}/no-gold")
    assert demo and tables["flight_performance"].count() == 720


def test_landed_public_sources_are_ingested_whole(spark, scratch, airport_csv):
    codes = ["TRD", "KRS", "SVG", "OUT"]
    lines = [json.dumps({"airport_code": c, "payload": json.loads(hourly(temperature_2m=[None, "cold"]))}) for c in codes]
    write(scratch, "hourly/part.json", "\n".join(lines) + "\n")
    options = {"airport_source": "csv", "weather_source": "hourly", "airport_csv": airport_csv, "weather_payloads": f"{scratch}/hourly"}
    records = jobs.source_records(spark, **options)
    assert records["airports"].count() == 4
    # SVG has no usable latitude and OUT is no airport.
    assert sorted({json.loads(r.value)["airport_code"] for r in records["weather"].collect()}) == ["KRS", "TRD"]
    jobs.ingest(f"{scratch}/raw", records={"weather": records["weather"]}, spark=spark, mode="record")
    rules = sorted(r.rule for r in spark.read.json(f"{scratch}/raw/_errors/weather").collect())
    assert rules == ["V2", "V2", "V8", "V8"]
    narrowed = jobs.source_records(spark, **options, airport_codes=["KRS", "TRD"], max_weather_airports=1)
    assert {json.loads(r.value)["airport_code"] for r in narrowed["weather"].collect()} == {"KRS"}
