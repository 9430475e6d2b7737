"""Silver layer: deduplicated sources with derived flight columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith import contracts
from aerolith.functions import delay_minutes, is_delayed
from aerolith.operators.dedupe import deduplicate


def derive_flight_columns(flights: DataFrame, missing_delay: str = "zero", cancelled_delay: str = "keep") -> DataFrame:
    """Lower-case status, delay minutes, cancellation and delay flags.

    ``missing_delay``: ``"zero"`` (a missing actual time gives 0.0) or ``"null"``.
    ``cancelled_delay``: ``"keep"`` (cancelled flights keep their delay) or
    ``"null"`` (cancelled flights get a null delay and are never delayed).
    """
    if cancelled_delay not in ("keep", "null"):
        raise ValueError(f"cancelled_delay must be 'keep' or 'null', got {cancelled_delay!r}")
    status = F.lower(F.col("status"))
    delay = delay_minutes("actual_departure_utc", "scheduled_departure_utc", missing_delay)
    if cancelled_delay == "null":
        delay = F.when(status == F.lit("cancelled"), F.lit(None).cast("double")).otherwise(delay)
    return (
        flights.withColumn("status", status)
        .withColumn("departure_delay_minutes", delay)
        .withColumn("is_cancelled", F.col("status") == F.lit("cancelled"))
        .withColumn("is_delayed", is_delayed("departure_delay_minutes"))
    )


def clean_flights(
    flights: DataFrame,
    missing_delay: str = "zero",
    cancelled_delay: str = "keep",
    order_by: Sequence[str | Column] | None = None,
    with_load_time: bool = False,
) -> DataFrame:
    """A8 on ``flight_id`` then P1–P3 (and P4 when ``with_load_time``)."""
    out = derive_flight_columns(
        deduplicate(flights, contracts.BUSINESS_KEYS[contracts.FLIGHTS], order_by),
        missing_delay,
        cancelled_delay,
    )
    return add_load_time(out, "_silver_loaded_at_utc") if with_load_time else out


def clean_source(
    source: str,
    frame: DataFrame,
    order_by: Sequence[str | Column] | None = None,
    with_load_time: bool = False,
    **flight_options,
) -> DataFrame:
    """Dispatch by source name; unknown names raise."""
    if source == contracts.FLIGHTS:
        return clean_flights(frame, order_by=order_by, with_load_time=with_load_time, **flight_options)
    keys = contracts.BUSINESS_KEYS.get(source)
    if keys is None:
        raise ValueError(f"Unsupported silver source: {source}")
    out = deduplicate(frame, keys, order_by)
    return add_load_time(out, "_silver_loaded_at_utc") if with_load_time else out


def add_load_time(df: DataFrame, name: str) -> DataFrame:
    """Layer load timestamp (P4). Never part of an oracle-compared output."""
    return df.withColumn(name, F.current_timestamp())
