from .batch import apply_batch, run_sql, select_columns
from .job import backfill_frame, job_frame, with_metrics

__all__ = ["apply_batch", "run_sql", "select_columns", "backfill_frame", "job_frame", "with_metrics"]
