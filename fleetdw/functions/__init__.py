from fleetdw.functions.dates import (
    calendar,
    calendar_attributes,
    calendar_days,
    date_key,
    key_to_date,
    sentinel_row,
    whole_days,
)
from fleetdw.functions.text import normalise_gearbox, null_of

__all__ = [
    "calendar",
    "calendar_attributes",
    "calendar_days",
    "date_key",
    "key_to_date",
    "normalise_gearbox",
    "null_of",
    "sentinel_row",
    "whole_days",
]
