from pulseboard.operators.bands import causal_bands, chart_bands
from pulseboard.operators.people import (
    attribute_days,
    first_seen,
    latest_attributes,
    merge_attribute_days,
    merge_attributes,
    merge_first_seen,
    user_attributes,
)
from pulseboard.operators.products import both_products, message_sides
from pulseboard.operators.slices import slice_sums

__all__ = [
    "attribute_days",
    "both_products",
    "causal_bands",
    "chart_bands",
    "first_seen",
    "latest_attributes",
    "merge_attribute_days",
    "merge_attributes",
    "merge_first_seen",
    "message_sides",
    "slice_sums",
    "user_attributes",
]
