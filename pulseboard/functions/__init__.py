from pulseboard.functions.clock import (
    Moment,
    Span,
    bucket_minutes,
    closed_buckets,
    day_of,
    history,
    last_days,
    rows_in,
    yesterday,
)
from pulseboard.functions.exprs import age_group, half_even, number_text, quarter_hour, ratio

__all__ = [
    "Moment",
    "Span",
    "age_group",
    "bucket_minutes",
    "closed_buckets",
    "day_of",
    "half_even",
    "history",
    "last_days",
    "number_text",
    "quarter_hour",
    "ratio",
    "rows_in",
    "yesterday",
]
