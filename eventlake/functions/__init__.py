from eventlake.functions.scalars import (
    boundary_diff,
    calendar_columns,
    classify_actor,
    event_category,
    event_description,
    hour_file_name,
    hour_of_file_name,
    is_test_repository,
    percent,
    round_half_up,
    strip_nul,
    surrogate_key,
    trunc_ts,
)

__all__ = [
    "boundary_diff",
    "calendar_columns",
    "classify_actor",
    "event_category",
    "event_description",
    "hour_file_name",
    "hour_of_file_name",
    "is_test_repository",
    "percent",
    "round_half_up",
    "strip_nul",
    "surrogate_key",
    "trunc_ts",
]
