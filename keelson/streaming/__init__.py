from keelson.streaming.counts import best_per_window, status_counts, window_counts
from keelson.streaming.runs import run_available, start_console

__all__ = ["best_per_window", "run_available", "start_console", "status_counts", "window_counts"]
