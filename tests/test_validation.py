"""Contract rules, one case table per rule.

A case changes a valid record; the table says which messages follow."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from aerolith import contracts
from aerolith.operators import validation as V
from aerolith.operators.routing import ACCEPTED, VERDICT, route
from aerolith.sources.raw import records_frame

GONE = object()

VALID = {
    "flights": {
        "flight_id": "sk-77/03",
        "flight_number": "SK77",
        "origin_airport": "OSL",
        "destination_airport": "ARN",
        "scheduled_departure_utc": "2025-11-03T17:05:00Z",
        "status": "scheduled",
    },
    "airports": {"airport_code": "OSL", "airport_name": "Gardermoen", "city": "Oslo", "country": "NO"},
    "weather": {
        "airport_code": "ARN",
        "observed_at_utc": "2025-11-03T16:50:00Z",
        "temperature_c": -3.25,
        "wind_speed_kmh": 18,
        "precipitation_mm": "0.4",
    },
    "passenger_events": {
        "event_id": "p9",
        "flight_id": "sk-77/03",
        "event_type": "mobile_check_in",
        "event_timestamp_utc": "2025-11-03T09:00:00.125Z",
        "channel": "web",
    },
}


def changed(source, **fields):
    record = {**VALID[source], **fields}
    return {k: v for k, v in record.items() if v is not GONE}


def said(spark, source, records):
    """Messages without their prefix, per record in order."""
    validated = V.validate(source, records_frame(spark, records))
    rows = V.error_messages(source, validated).orderBy("phase", F.col("record_ref").cast("int"), "position").collect()
    out = [[] for _ in records]
    for r in rows:
        prefix = f"{source}[{r.record_ref}] "
        assert r.message.startswith(prefix)
        out[int(r.record_ref)].append((r.rule, r.field, r.message.removeprefix(prefix)))
    return out


@pytest.mark.parametrize("source", contracts.SOURCES)
def test_valid_records_and_every_missing_or_empty_required_field(spark, source):
    required = contracts.required_fields(source)
    records = [VALID[source]]
    records += [changed(source, **{f: GONE}) for f in required]
    records += [changed(source, **{f: empty}) for f in required for empty in (None, "", " \t\x1f")]
    records.append({})
    got = said(spark, source, records)
    assert got[0] == []
    for f, messages in zip(required, got[1:]):
        assert messages == [("V1", None, f"missing required field(s): {f}")]
    for i, messages in enumerate(got[1 + len(required) : -1]):
        f = required[i // 3]
        assert messages == [("V2", f, f"required field is empty: {f}")]
    assert got[-1] == [("V1", None, "missing required field(s): " + ", ".join(required))]


VOCABULARY_CASES = [
    ("flights", "status", "landed", "cancelled, delayed, departed, scheduled"),
    ("flights", "status", "Departed", "cancelled, delayed, departed, scheduled"),
    ("passenger_events", "channel", "kiosk", "email, mobile_app, sms, web"),
    (
        "passenger_events",
        "event_type",
        "bag_drop",
        "boarding_pass_viewed, delay_notification_sent, mobile_check_in, rebooking_offer_viewed",
    ),
]


@pytest.mark.parametrize("source, field, value, allowed", VOCABULARY_CASES)
def test_controlled_values(spark, source, field, value, allowed):
    (got,) = said(spark, source, [changed(source, **{field: value})])
    assert got == [("V3", field, f"invalid value for {field}: {value}. Allowed values: {allowed}")]


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


TIMES = {
    "2025-11-03T17:05Z": utc(2025, 11, 3, 17, 5),
    "2025-11-03 17:05:09+00:00": utc(2025, 11, 3, 17, 5, 9),
    "2025-11-03T17:05:09.5Z": utc(2025, 11, 3, 17, 5, 9, 500_000),
    "2025-11-03T17Z": utc(2025, 11, 3, 17),
    "2025-11-03Z": utc(2025, 11, 3),
    "20251103Z": utc(2025, 11, 3),
    "20251103T170509Z": utc(2025, 11, 3, 17, 5, 9),
    "20251103T1705+00:00": utc(2025, 11, 3, 17, 5),
    "2025-11-03T17:05:09": None,
    "2025-11-03T17:05:09+01:00": None,
    "2025-02-30T10:00:00Z": None,
    "2025-11-03T24:30:00Z": None,
    "17:05:09Z": None,
    "yesterday": None,
    "2025-11-03T17:05:09Z\n": None,
    "0000-11-03T17:05:09Z": None,
    "2025-11-03T17:05:60Z": None,
    "2025-11-03T17:05:09.1234567Z": None,
}


def test_times_are_read_by_the_rule_that_accepts_them(spark):
    records = [changed("flights", scheduled_departure_utc=t) for t in TIMES] + [changed("flights", scheduled_departure_utc=20251103)]
    got = said(spark, "flights", records)
    for (text, wanted), messages in zip(TIMES.items(), got):
        bad = ("V4", "scheduled_departure_utc", f"invalid UTC timestamp for scheduled_departure_utc: {text}")
        assert messages == ([] if wanted else [bad]), text
    assert [m[0] for m in got[-1]] == ["V4"]
    validated = V.validate("flights", records_frame(spark, records[:-1]))
    typed = V.typed_records("flights", validated, keep=("_record_ref",)).select(
        "_record_ref", F.unix_micros("scheduled_departure_utc").alias("t")
    )
    read = {int(r._record_ref): r.t for r in typed.collect()}
    for i, wanted in enumerate(TIMES.values()):
        assert read[i] == (None if wanted is None else round(wanted.timestamp() * 1e6))


def test_optional_time_may_be_absent_or_empty_but_not_wrong(spark):
    values = [None, "", "noon", "2025-11-03T18:00:00Z"]
    got = said(spark, "flights", [changed("flights", actual_departure_utc=v) for v in values])
    assert [len(m) for m in got] == [0, 0, 1, 0]


@pytest.mark.parametrize("source, field", [("flights", "destination_airport"), ("airports", "airport_code"), ("weather", "airport_code")])
def test_airport_codes(spark, source, field):
    values = ["TRD", "trd", "TRDX", "T1D", "TRD\n", 123]
    got = said(spark, source, [changed(source, **{field: v}) for v in values])
    bad = [("V5", field, f"invalid IATA airport code for {field}")]
    assert got == [[], bad, bad, bad, bad, bad]


NUMBERS = [(-80, True), (60.0, True), (60.01, False), (" 5 ", True), ("1e1", True), ("mild", False), ("nan", False), ("5d", False), (True, False)]


def test_numeric_ranges_and_types(spark):
    records = [changed("weather", temperature_c=v) for v, _ in NUMBERS]
    records += [changed("weather", wind_speed_kmh=-0.5), changed("weather", precipitation_mm="501")]
    got = said(spark, "weather", records)
    for (value, fine), messages in zip(NUMBERS, got):
        assert [m[:2] for m in messages] == ([] if fine else [("V8", "temperature_c")]), value
    assert got[-2] == [("V8", "wind_speed_kmh", "invalid numeric range for wind_speed_kmh: -0.5")]
    assert got[-1] == [("V8", "precipitation_mm", "invalid numeric range for precipitation_mm: 501")]
    spots = [(90, True), (-90.5, False), ("12.5", True), (None, True), ("east", False)]
    got = said(spark, "airports", [changed("airports", longitude_deg=0, latitude_deg=v) for v, _ in spots])
    assert [m == [] for m in got] == [fine for _, fine in spots]


def test_order_of_messages(spark):
    worst = changed("flights", flight_number="", status="late", scheduled_departure_utc="x", origin_airport="o")
    rows = V.error_messages("flights", V.validate("flights", records_frame(spark, [worst, {"flight_id": "b"}])))
    ordered = rows.orderBy("phase", F.col("record_ref").cast("int"), "position").collect()
    assert [(r.record_ref, r.rule) for r in ordered] == [("1", "V1"), ("0", "V2"), ("0", "V3"), ("0", "V4"), ("0", "V5")]


def test_text_that_is_no_record_misses_everything(spark):
    raw = spark.createDataFrame([("{broken", "0"), ("7", "1")], "value string, _record_ref string")
    rules = {r.rule for r in V.error_messages("airports", V.validate("airports", raw)).collect()}
    assert rules == {"V1"}
    with pytest.raises(ValueError):
        V.validate("trains", raw)


def test_gate_summary_and_counts_agree(spark):
    records = [VALID["flights"], changed("flights", status="late", origin_airport="x"), changed("flights", flight_id="c")]
    raw = records_frame(spark, records)
    validated = V.validate("flights", raw)
    sizes = {mode: tuple(side.count() for side in V.gate(validated, mode)) for mode in ("dataset", "record")}
    assert sizes == {"dataset": (0, 3), "record": (2, 1)}
    clean = V.gate(validated, "record")[0]
    assert tuple(side.count() for side in V.gate(clean, "dataset")) == (2, 0)
    for mode, accepted in (("dataset", 0), ("record", 2)):
        wanted = ("flights", 3, accepted, 3 - accepted, 2)
        assert tuple(V.validation_summary("flights", validated, mode).first()) == wanted
        assert tuple(V.counted_summary("flights", V.error_counts("flights", raw), mode).first()) == wanted
    with pytest.raises(ValueError):
        V.gate(validated, "some")


def test_reference_defaults_to_the_business_key(spark):
    raw = spark.createDataFrame([('{"airport_code":"OSL"}',)], "value string")
    assert V.validate("airports", raw).first()["_record_ref"] == "OSL"


def test_routed_records_give_what_the_gates_give(spark, scratch):
    good, bad, worse = VALID["flights"], changed("flights", status="late"), {}
    for i, records in enumerate(([good, bad, worse, good], [good, good], [bad], [])):
        raw = records_frame(spark, records) if records else records_frame(spark, [good]).limit(0)
        routed = route("flights", raw, f"{scratch}/{i}")
        validated = V.validate("flights", raw).drop(V.DOC)
        for mode in ("dataset", "record"):
            sides = [sorted(map(tuple, side.drop(VERDICT).collect())) for side in routed.gate(mode)]
            assert sides == [sorted(map(tuple, side.collect())) for side in V.gate(validated, mode)]
            assert routed.summary(mode).collect() == V.validation_summary("flights", validated, mode).collect()
        assert sorted(map(tuple, routed.messages().collect())) == sorted(map(tuple, V.error_messages("flights", validated).collect()))
        clean = routed.only_accepted()
        assert [side.count() for side in clean.gate()] == [sum(r is good for r in records), 0]
    with pytest.raises(ValueError):
        routed.gate("some")


def test_routed_records_are_judged_once(spark, scratch):
    judged = spark.sparkContext.accumulator(0)
    raw = records_frame(spark, [VALID["weather"], {}] * 20)
    counted = F.udf(lambda text: judged.add(1) or text)
    routed = route("weather", raw.select(counted("value").alias("value"), "_record_ref"), f"{scratch}/once")
    assert [side.count() for mode in ("record", "dataset") for side in routed.gate(mode)] == [20, 20, 0, 40]
    assert routed.messages().count() == 20 and routed.summary().first().error_count == 20
    assert judged.value == 40
    plan = routed.of(ACCEPTED)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(verdict" in plan
