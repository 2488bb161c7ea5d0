"""Column expressions shared by the operators. All run inside the JVM; none is a UDF."""

from .dates import (
    cutoff_week,
    in_window,
    monday_of,
    parse_timestamp,
    week_label,
    whole_days_before,
)
from .jsontext import json_fault, json_field
from .kpi import burned, price_of, ratio, tier
from .listtext import is_list_text, list_length, parse_list_text

__all__ = [
    "burned", "cutoff_week", "in_window", "is_list_text", "json_fault", "json_field", "list_length", "monday_of",
    "parse_list_text", "parse_timestamp", "price_of", "ratio", "tier", "week_label",
    "whole_days_before",
]
