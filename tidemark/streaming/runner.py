"""Run a job as a Structured Streaming query.

One ``foreachBatch`` callback per micro-batch: the batch is persisted once,
checked for emptiness, transformed by the job's SQL and column list in the
batch's own session, written, and released.  The source is therefore read once
per batch and the progress metrics count each row once.

Fault tolerance comes from the checkpoint: offsets are committed only after
the callback returns, so a crash replays the batch.  With the default append
that means at-least-once delivery; ``output.idempotent`` makes the replay
replace the batch's rows (exactly-once result).

Functions, lookup views and session conf are set *before* ``start()``: the
micro-batch sessions are clones taken at start.
"""

from __future__ import annotations

import logging
from collections import deque

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.phone import register_functions
from ..plans.batch import apply_batch
from ..plans.job import job_frame
from ..session import checkpoint_setting, prepare_session
from ..sinks.current import merge_changes
from ..sinks.evolve import write_evolving
from ..sinks.table import checkpoint_path, console_rows, table_for, write_batch
from ..spec import JobSpec, OutputSpec
from .late import LateRows

log = logging.getLogger(__name__)


def register_lookup_tables(spark: SparkSession, tables: dict[str, str] | None) -> None:
    """``{view: path-or-table}``: static tables the job's SQL may join."""
    for view, src in (tables or {}).items():
        df = spark.read.parquet(src) if ("/" in src or ":" in src) else spark.table(src)
        df.createOrReplaceTempView(view)


class BatchHandler:
    """The ``foreachBatch`` callback of a job."""

    def __init__(self, spec: JobSpec, table: str | None = None, late: LateRows | None = None):
        self.spec = spec
        self.table = table
        self.late = late

    def transform(self, batch: DataFrame, batch_id: int) -> DataFrame:
        return apply_batch(batch, self.spec, batch_id)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        # the id kept in the checkpoint: a new checkpoint never meets old rows
        query_id = batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        batch = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                log.info("[batch=%s] empty, skipped", batch_id)
                return
            rows = batch
            if self.late is not None:
                rows, late = self.late.split(batch, batch_id)
                # by query and batch, so that a replay replaces them
                write_batch(late, OutputSpec(path=self.spec.output.late_path, idempotent=True),
                            batch_id=batch_id, query_id=query_id)
                log.info("[batch=%s] rows on time, late: %s", batch_id, self.late.counts[batch_id])
            out = self.transform(rows, batch_id)
            if self.spec.output.upsert_keys:
                o = self.spec.output
                merge_changes(out, o.path, o.upsert_keys, o.upsert_order, buckets=o.buckets,
                              query_id=query_id, batch_id=batch_id)
            elif self.spec.output.evolve:
                write_evolving(out, self.spec.output, batch_id=batch_id, query_id=query_id)
            elif self.spec.output.sink == "console":
                n = self.spec.output.console_rows
                console_rows(out, n).show(n, truncate=False)
            else:
                write_batch(out, self.spec.output, table=self.table, batch_id=batch_id, query_id=query_id)
        finally:
            batch.unpersist()


class ProgressLog(StreamingQueryListener):
    """Logs each micro-batch's input rows and the parse metrics (rows, rows per
    op, malformed) from the query's progress: no extra job, no action.  The last
    ``keep`` entries stay in ``batches``."""

    def __init__(self, names: set[str] | None = None, keep: int = 100):
        self.names = names
        self.batches: deque[dict] = deque(maxlen=keep)
        self.registered = False

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if self.names is not None and p.name not in self.names:
            return
        metrics = {k: dict(v.asDict()) for k, v in (p.observedMetrics or {}).items()}
        entry = {"name": p.name, "batch": p.batchId, "rows": p.numInputRows, "metrics": metrics}
        self.batches.append(entry)
        log.info("[%s batch=%s] %s rows %s", p.name, p.batchId, p.numInputRows, metrics)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def query_name(spec: JobSpec) -> str:
    prefix = "console_" if spec.output.sink == "console" else "streaming_"
    return prefix + spec.name


def job_checkpoint(spark: SparkSession, spec: JobSpec) -> str:
    """``checkpoint_location``, else under ``checkpoint_root``, else under the
    ``spark.checkpoint.dir`` setting.  All are the same in the next application,
    so a restarted job resumes; without any of them there is no such place."""
    if spec.checkpoint_location:
        return spec.checkpoint_location
    root = spec.checkpoint_root or checkpoint_setting(spark)
    if not root:
        raise ValueError(f"job {spec.name!r} has no checkpoint folder: set checkpoint_root, "
                         "checkpoint_location or spark.checkpoint.dir")
    return checkpoint_path(root, spec.name, "console" if spec.output.sink == "console" else "main")


def check_event_time(spec: JobSpec) -> None:
    """Combinations of settings that have no meaning."""
    out = spec.output
    if out.late_path and (spec.event_time is None or spec.event_time.stateful):
        raise ValueError("late_path splits a job's own rows: it needs event_time, without windows, sessions or dedup "
                         "(a second job over its output can have those)")
    if out.upsert_keys and not out.path:
        raise ValueError("a current-state table is kept at a path")


def start_job(spark: SparkSession, spec: JobSpec, *, available_now: bool = False,
              progress: ProgressLog | None = None) -> StreamingQuery:
    """Start the job's query.  ``available_now`` processes what the source holds
    now (still in rate-limited micro-batches) and stops: tests and backfills.
    ``progress`` (a ``ProgressLog``) is registered for this query's batches."""
    check_event_time(spec)
    prepare_session(spark, spec)
    if progress is not None:
        progress.names = (progress.names or set()) | {query_name(spec)}
        if not progress.registered:  # events arrive asynchronously: the caller
            spark.streams.addListener(progress)  # removes it when done with it
            progress.registered = True
    register_functions(spark, spec.functions, spec.phone_country_code)
    register_lookup_tables(spark, spec.lookup_tables)
    table = None
    if spec.output.sink == "table" and not spec.output.path:
        table = table_for(spec)
    late = LateRows(spec.event_time, job_checkpoint(spark, spec)) if spec.output.late_path else None
    handler = BatchHandler(spec, table, late)
    writer = (job_frame(spark, spec).writeStream
              .foreachBatch(handler)
              .option("checkpointLocation", job_checkpoint(spark, spec))
              .queryName(query_name(spec)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=spec.spark.trigger_interval)
    q = writer.start()
    log.info("started %s (id=%s) -> %s", query_name(spec), q.id, table or spec.output.path or "console")
    return q


def run_job(spark: SparkSession, spec: JobSpec, *, available_now: bool = False,
            progress: ProgressLog | None = None) -> StreamingQuery:
    """Start and wait.  An error in a batch stops the query and is raised here.
    After a bounded run the target table's file list is refreshed, so readers
    in this session see the new rows."""
    q = start_job(spark, spec, available_now=available_now, progress=progress)
    q.awaitTermination()
    if spec.output.sink == "table" and not spec.output.path:
        spark.catalog.refreshTable(table_for(spec))
    return q
