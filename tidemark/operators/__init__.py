from .asof import asof_join
from .conform import conform
from .envelope_ops import filter_by_operation, lift_metadata
from .event_time import dedup, event_windows, interval_join, sessions, with_watermark
from .ordered import running_totals
from .parse import parse_after_only, parse_changes
from .sketches import estimates, merge_sketches, sketch

__all__ = ["asof_join", "conform", "dedup", "estimates", "event_windows", "filter_by_operation", "interval_join",
           "lift_metadata", "merge_sketches", "parse_after_only", "parse_changes", "running_totals", "sessions",
           "sketch", "with_watermark"]
