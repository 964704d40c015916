"""Column expressions. All are built-in functions, so they stay inside generated code."""

from carelayers.functions.convert import (
    dose_numeric,
    duration_hours,
    parse_timestamp,
    safe_double,
    safe_long,
)
from carelayers.functions.identity import event_flag, observation_id, observation_parts
from carelayers.functions.text import clean_text, normalize_title, remap, upper_trim

__all__ = [
    "clean_text",
    "dose_numeric",
    "duration_hours",
    "event_flag",
    "normalize_title",
    "observation_id",
    "observation_parts",
    "parse_timestamp",
    "remap",
    "safe_double",
    "safe_long",
    "upper_trim",
]
