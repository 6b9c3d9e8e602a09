from tickwright.sources.decode import decode_json, decode_positional, split_rejected
from tickwright.sources.lines import read_day_lines
from tickwright.sources.tables import (
    jdbc_options,
    literal_keys,
    read_jdbc,
    read_table,
    read_tick_stream,
    ticks_of_day_by_sql,
    work_list,
    work_list_limits,
)

__all__ = [
    "decode_json",
    "decode_positional",
    "jdbc_options",
    "literal_keys",
    "read_day_lines",
    "read_jdbc",
    "read_table",
    "read_tick_stream",
    "split_rejected",
    "ticks_of_day_by_sql",
    "work_list",
    "work_list_limits",
]
