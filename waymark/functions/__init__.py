from .draws import draw, draw_below, draw_digits, draw_double, draw_int, draw_word
from .scalars import (
    day_of_week,
    hour_of_day,
    parse_timestamp,
    ratio,
    round_half_even,
    split_field,
    weekday,
    whole_number,
)

__all__ = [
    "day_of_week",
    "draw",
    "draw_below",
    "draw_digits",
    "draw_double",
    "draw_int",
    "draw_word",
    "hour_of_day",
    "parse_timestamp",
    "ratio",
    "round_half_even",
    "split_field",
    "weekday",
    "whole_number",
]
