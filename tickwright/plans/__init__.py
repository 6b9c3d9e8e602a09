from tickwright.plans.day_store import on_days_of, open_by_day, store_by_day, updown_day_stored
from tickwright.plans.features import day_features, day_features_of_ticks
from tickwright.plans.run_store import keep_runs, kept_runs
from tickwright.plans.updown import updown_day, updown_day_of_ticks

__all__ = [
    "day_features",
    "day_features_of_ticks",
    "keep_runs",
    "kept_runs",
    "on_days_of",
    "open_by_day",
    "store_by_day",
    "updown_day",
    "updown_day_of_ticks",
    "updown_day_stored",
]
