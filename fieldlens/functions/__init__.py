from fieldlens.functions.text import (collated, contains_ci, not_contains_ci, whitelist_strip, r_paste0,
                                     r_paste, WHITELIST_PATTERN)
from fieldlens.functions.numeric import safe_ratio, flags_agree, fill_numeric_zero, role_gate
from fieldlens.functions.dates import period_start, window_start, period_end, month_label, month_name_label

__all__ = [
    "collated", "contains_ci", "not_contains_ci", "whitelist_strip", "r_paste0", "r_paste", "WHITELIST_PATTERN",
    "safe_ratio", "flags_agree", "fill_numeric_zero", "role_gate",
    "period_start", "window_start", "period_end", "month_label", "month_name_label",
]
