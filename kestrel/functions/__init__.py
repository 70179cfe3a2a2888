"""Native column functions that replace the reference's row-wise Python UDFs."""

from kestrel.functions.dates import (parse_trip_ts, in_month, peak_time, text_hour, peak_flag_text,
                                     is_weekend, quarter_start, parse_month, parse_date, future_periods)
from kestrel.functions.geo import haversine_km, safe_ln, add_const, int_part
from kestrel.functions.strings import (money_to_double, to_text, text_length, upper_text, regex_group,
                                       instruction_text, whitespace_tokens, cap_tokens)

__all__ = [
    "parse_trip_ts", "in_month", "peak_time", "text_hour", "peak_flag_text", "is_weekend",
    "quarter_start", "parse_month", "parse_date", "future_periods",
    "haversine_km", "safe_ln", "add_const", "int_part",
    "money_to_double", "to_text", "text_length", "upper_text", "regex_group", "instruction_text",
    "whitespace_tokens", "cap_tokens",
]
