"""Column expressions; all are built-ins that stay inside code generation."""

from tripstats.functions.calendar import (
    date_text,
    day_number,
    is_weekend,
    iso_text,
    month_name,
    parse_timestamp,
)
from tripstats.functions.money import exact_add, exact_sum, exact_sum_over
from tripstats.functions.numbers import as_int, safe_ratio, share_percent, weighted_category
from tripstats.functions.text import is_named, normalize_name, normalized

__all__ = [
    "as_int",
    "date_text",
    "day_number",
    "exact_add",
    "exact_sum",
    "exact_sum_over",
    "is_named",
    "is_weekend",
    "iso_text",
    "month_name",
    "normalize_name",
    "normalized",
    "parse_timestamp",
    "safe_ratio",
    "share_percent",
    "weighted_category",
]
