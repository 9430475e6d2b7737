"""Contract validation over raw JSON records.

Raw records are JSON text (one object per row). Each record is parsed once
into a VARIANT, which keeps the three distinctions the rules need and a
typed reader loses: key absent vs JSON null, string vs number vs boolean,
and the original text of the value.

Every rule is a column expression; a record's ``errors`` column is an array
of ``struct<rule, field, message>`` in the rule order V1, V2 (fields sorted),
V3, V4 (contract order), then the source rule (V5/V6/V7). Nothing is
collected: the messages of a source are a distributed long-form DataFrame,
and the dataset-level gate is a scalar subquery used as a filter constant.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith import contracts

DOC = "_doc"
RECORD_REF = "_record_ref"

# Text patterns of the rules.
IATA_PATTERN = r"\A[A-Z]{3}\z"
# Python's str.strip() removes Unicode whitespace and the separators 0x1c-0x1f.
BLANK_PATTERN = r"(?U)\A[\s\x1c-\x1f]*\z"
# ISO-8601 in UTC (``Z`` or ``+00:00``), each accepted shape with its parser:
# extended date-time (hour, optional minutes / seconds / fraction, ``T`` or
# space), the same in basic form, and a date alone (midnight).
COMMON_UTC_TIMESTAMP = r"\A(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|\+00:00)\z"
UTC_TIMESTAMP_SHAPES = (
    (r"\d{4}-\d{2}-\d{2}[T ]\d{2}(?::\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?", "yyyy-MM-dd['T'][' ']HH[:mm[:ss[.SSSSSS]]]XXX"),
    (r"\d{8}[T ]\d{2}(?:\d{2}(?:\d{2}(?:\.\d{1,6})?)?)?", "yyyyMMdd['T'][' ']HH[mm[ss[.SSSSSS]]]XXX"),
    (r"\d{4}-\d{2}-\d{2}", "yyyy-MM-ddXXX"),
    (r"\d{8}", "yyyyMMddXXX"),
)
NUMERIC_TEXT_PATTERN = r"(?U)\A\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*\z"
NUMERIC_VARIANT_TYPES = r"\A(?:TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)\z"


def parse_records(raw: DataFrame, text_col: str = "value") -> DataFrame:
    """Parse JSON text into the ``_doc`` VARIANT (null for invalid JSON)."""
    return raw.withColumn(DOC, F.try_parse_json(F.col(text_col)))


class _Value:
    """Accessors for one top-level field of the parsed record. ``extract``
    materialises the field's presence, JSON type and text once as columns;
    the rules then read those columns instead of re-walking the VARIANT."""

    def __init__(self, name: str, extracted: bool = True):
        self.name = name
        if extracted:
            self._present = F.col(f"_p_{name}")
            self._null = F.col(f"_n_{name}")
            self.json_type = F.col(f"_t_{name}")
            self.text = F.col(f"_x_{name}")
        else:
            variant = F.try_variant_get(F.col(DOC), f"$.{name}", "variant")
            self._present = variant.isNotNull()
            self._null = F.is_variant_null(variant)
            self.json_type = F.schema_of_variant(variant)
            self.text = F.try_variant_get(F.col(DOC), f"$.{name}", "string")

    def columns(self) -> list[Column]:
        variant = F.try_variant_get(F.col(DOC), f"$.{self.name}", "variant")
        return [
            variant.isNotNull().alias(f"_p_{self.name}"),
            F.coalesce(F.is_variant_null(variant), F.lit(False)).alias(f"_n_{self.name}"),
            F.schema_of_variant(variant).alias(f"_t_{self.name}"),
            F.try_variant_get(F.col(DOC), f"$.{self.name}", "string").alias(f"_x_{self.name}"),
        ]

    @property
    def present(self) -> Column:
        return self._present

    @property
    def is_string(self) -> Column:
        return F.coalesce(self.json_type == F.lit("STRING"), F.lit(False))

    @property
    def blank(self) -> Column:
        """Present and JSON null, or a whitespace-only string."""
        return self.present & (self._null | (self.is_string & self.text.rlike(BLANK_PATTERN)))

    @property
    def filled(self) -> Column:
        return self.present & ~self.blank


def parse_utc_timestamp(text: Column) -> Column:
    """Timestamp of an accepted UTC text; null when rejected or invalid
    (e.g. year 0, month 13, 30 February, hour 24). An anchored regex decides the
    shape and the shape's pattern parses it; the common shape comes first and is
    left to the cast, which reads it several times faster than a pattern. Rule
    and reader share this, so no accepted time is lost. ISO week dates are
    rejected, which a record's error says."""
    out = F.when(text.rlike(COMMON_UTC_TIMESTAMP), text.try_cast("timestamp"))
    for shape, layout in UTC_TIMESTAMP_SHAPES:
        matches, parsed = text.rlike(rf"\A(?!0000)(?:{shape})(?:Z|\+00:00)\z"), F.try_to_timestamp(text, F.lit(layout))
        out = out.when(matches, parsed)
    return out


def _timestamp_ok(v: _Value) -> Column:
    return v.is_string & parse_utc_timestamp(v.text).isNotNull()


def _code_ok(v: _Value) -> Column:
    return v.is_string & F.coalesce(v.text.rlike(IATA_PATTERN), F.lit(False))


def numeric_value(v: _Value) -> Column:
    """Double of a JSON number or numeric string (booleans and other text are
    null)."""
    stripped = F.regexp_replace(v.text, r"(?U)\A\s+|\s+\z", "")
    is_number = F.coalesce(v.json_type.rlike(NUMERIC_VARIANT_TYPES), F.lit(False))
    is_numeric_text = v.is_string & F.coalesce(v.text.rlike(NUMERIC_TEXT_PATTERN), F.lit(False))
    return F.when(is_number | is_numeric_text, stripped.try_cast("double"))


def _in_range(v: _Value, low: float, high: float) -> Column:
    x = numeric_value(v)
    return F.coalesce(x.between(low, high), F.lit(False))


def _error(rule: str, field: str | None, message: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), F.lit(field).cast("string").alias("field"), message.alias("message"))


@dataclass(frozen=True)
class _Check:
    """One rule on one field (V1: on all): when it is broken and what is said."""

    rule: str
    field: str | None
    broken: Column
    text: Column


def _checks(source: str) -> list[_Check]:
    """All rules of a source in message order: V1, V2 (fields sorted), V3 and
    V4 (contract order), then airport codes and numeric ranges."""
    specs = contracts.fields(source)
    required = contracts.required_fields(source)
    missing = F.array_compact(F.array(*[F.when(~_Value(f).present, F.lit(f)) for f in required]))
    said = F.concat(F.lit("missing required field(s): "), F.array_join(missing, ", "))
    checks = [_Check("V1", None, F.size(missing) > 0, said)]
    checks += [_Check("V2", f, _Value(f).blank, F.lit(f"required field is empty: {f}")) for f in required]
    for spec in specs:
        allowed = contracts.VOCABULARIES.get(source, {}).get(spec.name)
        if allowed:
            v = _Value(spec.name)
            known = F.coalesce(v.text.isin(list(allowed)), F.lit(False))
            listed = F.lit(". Allowed values: " + ", ".join(sorted(allowed)))
            said = F.concat(F.lit(f"invalid value for {spec.name}: "), v.text, listed)
            checks.append(_Check("V3", spec.name, v.filled & ~known, said))
    for spec in specs:
        if spec.dtype == "timestamp":
            v = _Value(spec.name)
            said = F.concat(F.lit(f"invalid UTC timestamp for {spec.name}: "), v.text)
            checks.append(_Check("V4", spec.name, v.filled & ~_timestamp_ok(v), said))
    for name in contracts.CODE_FIELDS.get(source, ()):
        v = _Value(name)
        checks.append(_Check("V5", name, v.filled & ~_code_ok(v), F.lit(f"invalid IATA airport code for {name}")))
    for name, (low, high) in contracts.NUMERIC_RANGES.get(source, {}).items():
        v = _Value(name)
        said = F.concat(F.lit(f"invalid numeric range for {name}: "), v.text)
        checks.append(_Check("V8", name, v.filled & ~_in_range(v, low, high), said))
    return checks


def record_errors(source: str, ref: Column) -> Column:
    """``array<struct<rule, field, message>>`` of all rule violations of a
    record, in rule order; empty when the record is valid."""
    prefix = F.concat(F.lit(f"{source}["), ref.cast("string"), F.lit("] "))
    return F.array_compact(
        F.array(*[F.when(c.broken, _error(c.rule, c.field, F.concat(prefix, c.text))) for c in _checks(source)])
    )


def _extracted(source: str, raw: DataFrame, text_col: str) -> tuple[DataFrame, list[str]]:
    """Parsed records with every contract field taken out once."""
    names = contracts.field_names(source)  # unknown source → ValueError
    parsed = parse_records(raw, text_col)
    return parsed.select(*parsed.columns, *[c for n in names for c in _Value(n, extracted=False).columns()]), parsed.columns


def validate(source: str, raw: DataFrame, text_col: str = "value", ref_col: str = RECORD_REF) -> DataFrame:
    """Add ``_doc`` (parsed record) and ``errors`` to raw JSON records (V9).

    ``ref_col`` names the column used as record reference in messages (the
    record's position for array files); when absent, the business key is
    used."""
    extracted, base = _extracted(source, raw, text_col)
    if ref_col not in extracted.columns:
        keys = contracts.BUSINESS_KEYS[source]
        extracted = extracted.withColumn(ref_col, F.concat_ws(",", *[_Value(k).text for k in keys]))
        base = base + [ref_col]
    # The rule expression is produced by a one-row ``inline`` rather than a
    # projection: predicate pushdown would otherwise substitute it into every
    # filter on ``errors`` below (down to the scan or a join condition) and
    # evaluate the whole rule set, parse included, several times per record.
    row = F.struct(*[F.col(c) for c in base], record_errors(source, F.col(ref_col)).alias("errors"))
    return extracted.select(F.inline(F.array(row)))


def error_counts(source: str, raw: DataFrame, text_col: str = "value") -> DataFrame:
    """``error_count`` per raw record: the rules are counted, no message is
    built. Feeds ``counted_summary``."""
    extracted, _ = _extracted(source, raw, text_col)
    count = sum((F.coalesce(c.broken, F.lit(False)).cast("int") for c in _checks(source)), F.lit(0))
    return extracted.select(count.alias("error_count"))


def error_messages(source: str, validated: DataFrame, ref_col: str = RECORD_REF) -> DataFrame:
    """Long form: one row per violation (source, record ref, phase, position
    inside the record, rule, field, message). Ordering by (phase, ref,
    position) gives the reference's message order: all V1 messages first,
    then each record's remaining messages."""
    exploded = validated.select(F.col(ref_col).alias("record_ref"), F.posexplode("errors").alias("position", "e"))
    return exploded.select(
        F.lit(source).alias("source"),
        "record_ref",
        F.when(F.col("e.rule") == F.lit("V1"), F.lit(0)).otherwise(F.lit(1)).alias("phase"),
        "position",
        F.col("e.rule").alias("rule"),
        F.col("e.field").alias("field"),
        F.col("e.message").alias("message"),
    )


def gate(validated: DataFrame, mode: str = "dataset") -> tuple[DataFrame, DataFrame]:
    """Split validated records into (accepted, rejected).

    ``mode="dataset"`` (V10): any error rejects the whole source. The flag is
    a scalar subquery (a global aggregate, partially aggregated per task),
    evaluated once and used as a constant in the filter, so nothing goes
    through the driver and no join is needed. ``mode="record"`` (X1):
    invalid records go to the quarantine side, valid ones are accepted.
    Each side evaluates the rules again: where both are used, ``routing.route``
    writes the judged records once.
    """
    has_errors = F.size("errors") > 0
    if mode == "record":
        return validated.where(~has_errors), validated.where(has_errors)
    if mode != "dataset":
        raise ValueError(f"mode must be 'dataset' or 'record', got {mode!r}")
    rejected_source = validated.agg(F.coalesce(F.max(has_errors.cast("int")), F.lit(0))).scalar() == F.lit(1)
    return validated.where(~rejected_source), validated.where(rejected_source)


def validation_summary(source: str, validated: DataFrame, mode: str = "dataset") -> DataFrame:
    """One row per source: records, accepted, rejected, error count."""
    return counted_summary(source, validated.select(F.size("errors").alias("error_count")), mode)


def counted_summary(source: str, counts: DataFrame, mode: str = "dataset") -> DataFrame:
    """V11 from the error count of every record."""
    agg = counts.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("error_count") > 0).alias("invalid_records"),
        F.coalesce(F.sum("error_count"), F.lit(0)).cast("bigint").alias("errors"),
    )
    if mode == "dataset":
        accepted = F.when(F.col("invalid_records") > 0, F.lit(0)).otherwise(F.col("records"))
    else:
        accepted = F.col("records") - F.col("invalid_records")
    return agg.select(
        F.lit(source).alias("source"),
        F.col("records"),
        accepted.cast("bigint").alias("accepted_records"),
        (F.col("records") - accepted).cast("bigint").alias("rejected_records"),
        F.col("errors").alias("error_count"),
    )


def validation_totals(summary: DataFrame) -> DataFrame:
    """V11 totals: accepted and rejected records over all sources."""
    return summary.agg(
        F.coalesce(F.sum("accepted_records"), F.lit(0)).cast("bigint").alias("total_accepted_records"),
        F.coalesce(F.sum("rejected_records"), F.lit(0)).cast("bigint").alias("total_rejected_records"),
    )


def typed_records(source: str, validated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Contract-typed columns from the parsed records (bronze reader for
    text-validated sources). Timestamps go through the same normaliser as
    V4, numbers accept numeric strings, so nothing valid is silently nulled."""
    names = contracts.field_names(source)
    extracted = validated.select(*[c for n in names for c in _Value(n, extracted=False).columns()], *keep)
    cols = []
    for spec in contracts.fields(source):
        v = _Value(spec.name)
        if spec.dtype == "timestamp":
            c = F.when(v.is_string, parse_utc_timestamp(v.text))
        elif spec.dtype == "float":
            c = numeric_value(v)
        else:
            c = F.when(~v._null, v.text)
        cols.append(c.alias(spec.name))
    return extracted.select(*cols, *keep)
