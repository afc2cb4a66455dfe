from sunledger.functions.exact import (
    PART_NAMES,
    exact_mean,
    exact_parts,
    exact_percentage,
    exact_sum,
    merged_sum,
    parts_total,
    same_or_mean,
)
from sunledger.functions.messages import message_key, message_value
from sunledger.functions.times import parse_time, wall_clock, wall_clock_literal, window_range, wire_time

__all__ = [
    "PART_NAMES",
    "exact_mean",
    "exact_parts",
    "exact_percentage",
    "exact_sum",
    "merged_sum",
    "parts_total",
    "same_or_mean",
    "message_key",
    "message_value",
    "parse_time",
    "wall_clock",
    "wall_clock_literal",
    "window_range",
    "wire_time",
]
