from aerolith.functions.columns import (
    DELAY_THRESHOLD_MINUTES,
    WIND_BUCKET_EDGES,
    WIND_BUCKET_LABELS,
    bool_count,
    delay_minutes,
    is_delayed,
    mean_minutes,
    pearson,
    route_key,
    safe_rate,
    wind_bucket,
    wind_bucket_index,
)

__all__ = [
    "DELAY_THRESHOLD_MINUTES",
    "WIND_BUCKET_EDGES",
    "WIND_BUCKET_LABELS",
    "bool_count",
    "delay_minutes",
    "is_delayed",
    "mean_minutes",
    "pearson",
    "route_key",
    "safe_rate",
    "wind_bucket",
    "wind_bucket_index",
]
