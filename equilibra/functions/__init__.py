"""Column expressions: built-in Spark functions only, so everything stays in
whole-stage codegen and no row crosses into Python."""

from equilibra.functions.columns import (
    WEEK_YEAR,
    add_week_year,
    flag_text,
    iso_week,
    iso_year,
    odd_tokens,
    parse_float,
    patient_id,
    sample_floats,
    sample_tokens,
    sample_values,
    session_date,
    start_time,
    week_keys,
)

__all__ = [
    "WEEK_YEAR",
    "add_week_year",
    "flag_text",
    "iso_week",
    "iso_year",
    "odd_tokens",
    "parse_float",
    "patient_id",
    "sample_floats",
    "sample_tokens",
    "sample_values",
    "session_date",
    "start_time",
    "week_keys",
]
