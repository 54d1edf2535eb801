from tallyloom.streaming.keyed import latest_keys, start_key_upserts
from tallyloom.streaming.metrics import batch_metrics, record_metrics
from tallyloom.streaming.windows import (
    DEFAULT_WINDOW,
    compact_windows,
    event_time,
    latest_windows,
    open_windows,
    start_window_appends,
    start_window_upserts,
    tumbling_sum,
)

__all__ = [
    "DEFAULT_WINDOW",
    "batch_metrics",
    "compact_windows",
    "event_time",
    "latest_keys",
    "latest_windows",
    "open_windows",
    "record_metrics",
    "start_key_upserts",
    "start_window_appends",
    "start_window_upserts",
    "tumbling_sum",
]
