"""Column-level building blocks: expressions only, no jobs."""

from .keys import NULL_KEY_TOKEN, surrogate_key
from .semistructured import payload_field
from .temporal import boundaries_between, clock_key, date_key, minute_of_day
from .text import contains_ignoring_case, title_case

__all__ = [
    "NULL_KEY_TOKEN",
    "boundaries_between",
    "clock_key",
    "contains_ignoring_case",
    "date_key",
    "minute_of_day",
    "payload_field",
    "surrogate_key",
    "title_case",
]
