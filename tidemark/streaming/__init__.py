from .chains import broken_chains
from .runner import BatchHandler, ProgressLog, register_lookup_tables, run_job, start_job

__all__ = ["BatchHandler", "ProgressLog", "broken_chains", "register_lookup_tables", "run_job", "start_job"]
