"""Column builders: pure functions from Columns to a Column, no actions."""

from orderlens.functions.text import (
    address_line, blank_to_null, concat_text, nvl, nvl2, phone_line,
    serial_prefix, serial_suffix, strip_chars, upper_eq,
)
from orderlens.functions.dates import (
    as_ts, change_guard, date_text, days_before, text_to_date, text_to_number,
    valid_at,
)
from orderlens.functions.labels import (
    category_label, conditional_price, country_choice, gate, override_description,
    pattern_flag, retained, status_label, yes_flag,
)

__all__ = [
    "address_line", "blank_to_null", "concat_text", "nvl", "nvl2", "phone_line",
    "serial_prefix", "serial_suffix", "strip_chars", "upper_eq", "as_ts",
    "change_guard", "date_text", "days_before", "text_to_date", "text_to_number",
    "valid_at", "category_label", "conditional_price", "country_choice", "gate",
    "override_description", "pattern_flag", "retained", "status_label", "yes_flag",
]
