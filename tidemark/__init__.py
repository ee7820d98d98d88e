"""tidemark: change-data-capture stream analytics on Spark.

Change records (before, after, source, op, ts_ms) from Kafka or files become
typed rows through native Catalyst expressions; a job runs its own SQL on each
micro-batch and writes the result to a table.
"""

from .functions import (
    after_image, before_image, record_op, safe_cast, source_metadata,
)
from .job_config import load_job_yaml, spec_from_job_config
from .operators import (
    asof_join, conform, dedup, estimates, event_windows, filter_by_operation, interval_join, lift_metadata,
    merge_sketches, parse_after_only, parse_changes, running_totals, sessions, sketch, with_watermark,
)
from .plans.batch import apply_batch, run_sql, select_columns
from .session import prepare_session, shared_dir, shared_root
from .sinks.current import expire, merge_changes, read_current
from .sinks.evolve import read_evolved, write_evolving
from .sinks.table import checkpoint_path, console_rows, resolve_table_name, write_batch
from .sources.change_stream import kafka_options, read_change_batch, read_change_stream
from .sources.feed import change_feed
from .spec import DeclaredSchema, EventTimeSpec, JobSpec, OutputSpec, SourceSpec, SparkSettings
from .streaming.chains import broken_chains
from .streaming.runner import BatchHandler, ProgressLog, run_job, start_job

__all__ = [
    "after_image", "before_image", "record_op", "safe_cast", "source_metadata",
    "conform", "filter_by_operation", "lift_metadata", "parse_after_only", "parse_changes",
    "running_totals", "load_job_yaml", "spec_from_job_config", "ProgressLog",
    "apply_batch", "run_sql", "select_columns",
    "prepare_session", "shared_dir", "shared_root",
    "checkpoint_path", "console_rows", "resolve_table_name", "write_batch",
    "kafka_options", "read_change_batch", "read_change_stream", "change_feed",
    "asof_join", "broken_chains", "dedup", "estimates", "event_windows", "expire", "interval_join", "merge_changes",
    "merge_sketches", "read_current", "read_evolved", "sessions", "sketch", "with_watermark", "write_evolving",
    "DeclaredSchema", "EventTimeSpec", "JobSpec", "OutputSpec", "SourceSpec", "SparkSettings",
    "BatchHandler", "run_job", "start_job",
]
