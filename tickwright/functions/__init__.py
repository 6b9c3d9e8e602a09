from tickwright.functions.arithmetic import amount, cents, half_up, half_up_ratio, root_steps, whole_quotient
from tickwright.functions.text import (
    clean_text,
    day_key,
    parse_day,
    plain_long,
    plain_price,
    plain_statistic,
    tab_line,
    without_suffix,
)

__all__ = [
    "amount",
    "cents",
    "clean_text",
    "day_key",
    "half_up",
    "half_up_ratio",
    "parse_day",
    "plain_long",
    "plain_price",
    "plain_statistic",
    "root_steps",
    "tab_line",
    "whole_quotient",
    "without_suffix",
]
