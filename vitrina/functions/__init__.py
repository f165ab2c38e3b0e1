"""Column builders: each takes and returns ``pyspark.sql.Column``."""

from vitrina.functions.numeric import decode_spelled_number, positive_amount, positive_int
from vitrina.functions.temporal import (
    calendar_columns,
    month_key,
    null_outside_date,
    null_outside_ts,
    parse_date_multi,
    parse_ts_multi,
    parse_ts_three,
)
from vitrina.functions.text import (
    capitalize_first,
    clean_code,
    clean_email,
    clean_title,
    is_valid_email,
    normalize_email,
    scrub_null_tokens,
)

__all__ = [
    "decode_spelled_number", "positive_amount", "positive_int",
    "calendar_columns", "month_key", "null_outside_date", "null_outside_ts",
    "parse_date_multi", "parse_ts_multi", "parse_ts_three",
    "capitalize_first", "clean_code", "clean_email", "clean_title",
    "is_valid_email", "normalize_email", "scrub_null_tokens",
]
