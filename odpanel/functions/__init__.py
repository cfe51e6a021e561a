"""Column-level helpers. Each returns a Column built from built-in functions."""

from odpanel.functions.columns import (SENTINELS, blank_or_null, clean_cell, exact_mean,
                                       literal_bool, literal_date, literal_number,
                                       literal_text, null_strict_sum,
                                       safe_div, trim_blanks, year_prefix)
from odpanel.functions.labels import REGION_PREFIXES, normalize_label

__all__ = [
    "SENTINELS", "blank_or_null", "clean_cell", "exact_mean", "literal_bool", "literal_date", "literal_number",
    "literal_text", "null_strict_sum", "safe_div", "trim_blanks", "year_prefix",
    "REGION_PREFIXES", "normalize_label",
]
