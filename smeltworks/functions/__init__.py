"""Column helpers. Every one is a composition of built-in JVM expressions; there are no UDFs."""

from smeltworks.functions.dates import month_index, year_month
from smeltworks.functions.numbers import (
    div_round,
    exact_avg,
    pct_change,
    safe_decimal,
    safe_int,
)
from smeltworks.functions.text import canonical_uuid, is_present, is_uuid

__all__ = [
    "canonical_uuid",
    "div_round",
    "exact_avg",
    "is_present",
    "is_uuid",
    "month_index",
    "pct_change",
    "safe_decimal",
    "safe_int",
    "year_month",
]
