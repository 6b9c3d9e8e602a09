from tickwright.streaming.change_log import replay, stream_change_log
from tickwright.streaming.changes import stream_price_changes
from tickwright.streaming.day_window import day_window, latest_rows, stream_day_window
from tickwright.streaming.drain import drain

__all__ = ["day_window", "drain", "latest_rows", "replay", "stream_change_log", "stream_day_window", "stream_price_changes"]
