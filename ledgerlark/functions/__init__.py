from ledgerlark.functions.columns import (
    DEFAULT_DATE_FORMATS,
    absolute_quantity,
    all_of,
    any_of,
    date_text,
    drop_decimal_zero,
    finite,
    is_blank,
    lenient_double,
    line_status,
    money_round,
    non_blank,
    positive_finite,
    revenue_flag,
    segment,
    strict_timestamp,
    trim_text,
    valid_quantity,
    whole,
)

__all__ = [
    "DEFAULT_DATE_FORMATS",
    "absolute_quantity",
    "all_of",
    "any_of",
    "date_text",
    "drop_decimal_zero",
    "finite",
    "is_blank",
    "lenient_double",
    "line_status",
    "money_round",
    "non_blank",
    "positive_finite",
    "revenue_flag",
    "segment",
    "strict_timestamp",
    "trim_text",
    "valid_quantity",
    "whole",
]
