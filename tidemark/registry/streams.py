"""Registered queries for the streaming job: file-stream source, micro-batch
driver, per-batch SQL, table sink, checkpoint/restart, overwrite, idempotent
replay and the console preview.

Each query writes the ``orders`` change feed as JSON text files into a fresh
folder under the shared checkpoint folder (in one pass, or one file set per
operation written one after another when the order of the sets matters), runs
the job over them with ``availableNow`` and returns what the sink holds.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import parse_changes
from ..plans.batch import apply_batch, materialize
from ..plans.job import METRICS_NAME
from ..session import checkpoint_setting, shared_dir
from ..sinks.table import BATCH_ID_COLUMN, QUERY_ID_COLUMN, console_rows, write_batch
from ..spec import JobSpec, OutputSpec, SourceSpec, SparkSettings
from ..streaming.runner import BatchHandler, ProgressLog, query_name, run_job
from .common import ORDERS_COLS, ORDERS_SCHEMA, ORDERS_VIEW, as_ntz, op_sql, orders_feed, ready

OP = op_sql("o_orderkey")
GROUPS = 4
STREAM_DATABASE = "tidemark_streams"


def _workdir(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, "tidemark", "streams", name, unique=True, temporary=True)


def write_feed_files(spark: SparkSession, sf: str, folder: str, groups=None) -> None:
    """Append the feed's records as text files: all of them in one pass, or,
    when ``groups`` is given, one file set per op class (key mod 4) in that
    order, so that modification times order the sets."""
    feed = orders_feed(spark, sf)
    if groups is None:
        feed.select("value").write.mode("append").text(folder)
        return
    feed = feed.withColumn("_g", F.pmod(F.col("key").cast("bigint"), F.lit(GROUPS)))
    for g in groups:
        feed.filter(F.col("_g") == g).select("value").write.mode("append").text(folder)


def _job(work: str, *, sql: str | None = None, mode: str = "append",
         max_files: int | None = 4, idempotent: bool = False, table: str = "",
         default_checkpoint: bool = False) -> JobSpec:
    # the job (and its query) is named after its folder, so two runs never
    # share a query name; the SQL sees the batch under the fixed view name
    return JobSpec(
        name=f"{ORDERS_VIEW}_{work.rstrip('/').rsplit('/', 1)[-1]}",
        schema=ORDERS_SCHEMA,
        source=SourceSpec(kind="files", path=f"{work}/in", max_files_per_trigger=max_files),
        output=OutputSpec(sql=sql, temp_view=ORDERS_VIEW, path=None if table else f"{work}/out",
                          target_table=table, write_mode=mode, idempotent=idempotent,
                          table_properties={"feed": "orders"} if table else {}),
        # by default under spark.checkpoint.dir; that may be unset where queries are only tried out
        checkpoint_root=None if default_checkpoint and checkpoint_setting(SparkSession.getActiveSession()) else work,
        catalog="spark_catalog",
    )


def _result(spark: SparkSession, work: str) -> DataFrame:
    return spark.read.parquet(f"{work}/out")


def stream_append(spark, sf):
    ready(spark)
    work = _workdir(spark, "append")
    write_feed_files(spark, sf, f"{work}/in")
    run_job(spark, _job(work), available_now=True)
    return as_ntz(_result(spark, work))


STREAM_SQL = (f"select o_orderkey, o_custkey, o_totalprice, op from {ORDERS_VIEW} "
              "where op <> 'd' and o_totalprice > 50000")


def stream_sql(spark, sf):
    ready(spark)
    work = _workdir(spark, "sql")
    write_feed_files(spark, sf, f"{work}/in")
    run_job(spark, _job(work, sql=STREAM_SQL), available_now=True)
    return _result(spark, work)


BATCH_COUNT_SQL = f"select op, count(*) as n from {ORDERS_VIEW} group by op"


def stream_batch_counts(spark, sf):
    """Per-batch aggregates (the SQL sees one micro-batch) add up to the totals."""
    ready(spark)
    work = _workdir(spark, "counts")
    write_feed_files(spark, sf, f"{work}/in")
    run_job(spark, _job(work, sql=BATCH_COUNT_SQL), available_now=True)
    return _result(spark, work).groupBy("op").agg(F.sum("n").alias("n"))


def stream_restart(spark, sf):
    """Two runs at the job's default checkpoint place, files added in between:
    every row once."""
    ready(spark)
    work = _workdir(spark, "restart")
    write_feed_files(spark, sf, f"{work}/in", groups=[0, 1])
    run_job(spark, _job(work, default_checkpoint=True), available_now=True)
    write_feed_files(spark, sf, f"{work}/in", groups=[2, 3])
    run_job(spark, _job(work, default_checkpoint=True), available_now=True)
    return as_ntz(_result(spark, work))


def _new_table(spark: SparkSession, name: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS spark_catalog.{STREAM_DATABASE}")
    return f"{STREAM_DATABASE}.{name}_{uuid.uuid4().hex}"


def stream_table_append(spark, sf):
    """A catalog table by a two-part name: made with its properties, then appended to."""
    ready(spark)
    work, table = _workdir(spark, "table"), _new_table(spark, "orders")
    write_feed_files(spark, sf, f"{work}/in")
    run_job(spark, _job(work, table=table), available_now=True)
    return as_ntz(spark.table(f"spark_catalog.{table}"))


EMPTY_SQL = f"select count(*) as n from {ORDERS_VIEW}"


def stream_empty_batch(spark, sf):
    """A batch without rows never reaches the SQL, which would give a row for it."""
    ready(spark)
    work = _workdir(spark, "empty")
    spec = _job(work, sql=EMPTY_SQL)
    parsed = parse_changes(orders_feed(spark, sf), ORDERS_SCHEMA)
    handler = BatchHandler(spec)
    for batch_id, batch in enumerate((parsed.filter("op is null"), parsed, parsed.filter("op = 'none'"))):
        handler(batch, batch_id)
    return _result(spark, work).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("batches"))


def stream_overwrite(spark, sf):
    """Overwrite mode replaces the table on every batch: after one run per file
    set (one batch each), the table holds the last set's rows."""
    ready(spark)
    work = _workdir(spark, "overwrite")
    for g in range(GROUPS):
        write_feed_files(spark, sf, f"{work}/in", groups=[g])
        run_job(spark, _job(work, mode="overwrite", max_files=None), available_now=True)
    return as_ntz(_result(spark, work))


def stream_idempotent(spark, sf):
    """A job into a catalog table whose batches are handed to the sink a second time
    under the same query and batch ids (a replay after a crash): kept once."""
    ready(spark)
    work, table = _workdir(spark, "idempotent"), _new_table(spark, "orders")
    spec = _job(work, idempotent=True, table=table)
    write_feed_files(spark, sf, f"{work}/in")
    run_job(spark, spec, available_now=True)
    full = f"spark_catalog.{table}"
    done = spark.table(full)
    batch_id, query_id = done.agg(F.max(BATCH_ID_COLUMN)).first()[0], done.first()[QUERY_ID_COLUMN]
    last = materialize(done.filter(F.col(BATCH_ID_COLUMN) == batch_id).drop(BATCH_ID_COLUMN, QUERY_ID_COLUMN))
    write_batch(last, spec.output, table=full, batch_id=batch_id, query_id=query_id)
    spark.catalog.refreshTable(full)
    return as_ntz(spark.table(full).drop(BATCH_ID_COLUMN, QUERY_ID_COLUMN))


PREVIEW_SQL = f"select * from {ORDERS_VIEW} order by o_orderkey"


def console_preview(spark, sf):
    """The rows the console sink shows for a batch: the first 20 of its SQL result."""
    ready(spark)
    batch = parse_changes(orders_feed(spark, sf), ORDERS_SCHEMA)
    out = apply_batch(batch, JobSpec(name=ORDERS_VIEW, output=OutputSpec(sql=PREVIEW_SQL, sink="console")))
    return as_ntz(console_rows(out, 20))


def stream_progress(spark, sf):
    """Rows and parse metrics that the named query reports per micro-batch, added up; the
    job states its retention and idle interval for the session."""
    ready(spark)
    work = _workdir(spark, "progress")
    write_feed_files(spark, sf, f"{work}/in")
    spec = _job(work)
    spec.spark = SparkSettings(min_batches_to_retain=7, no_data_progress_event_interval=50_000)
    log = ProgressLog()
    try:
        done = run_job(spark, spec, available_now=True, progress=log)
        reported = {p["batchId"] for p in done.recentProgress}
        for _ in range(300):         # events arrive a little later than the query ends
            if reported <= {b["batch"] for b in log.batches}:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    kept = spark.conf.get("spark.sql.streaming.minBatchesToRetain")
    rows = [(b["name"] == query_name(spec), b["rows"], *(int(b["metrics"][METRICS_NAME][k]) for k in _METRICS), int(kept))
            for b in log.batches if METRICS_NAME in b["metrics"]]
    batches = spark.createDataFrame(rows, f"named boolean, n long, {', '.join(f'{k} long' for k in _METRICS)}, kept int")
    return batches.groupBy("named", "kept").agg(F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in _METRICS])


_METRICS = ("rows", "creates", "updates", "deletes", "malformed")


def stream_sql_twice(spark, sf):
    """The streaming twin of a batch read twice."""
    ready(spark)
    work = _workdir(spark, "twice")
    write_feed_files(spark, sf, f"{work}/in")
    run_job(spark, _job(work, sql=f"TABLE {ORDERS_VIEW} UNION ALL TABLE {ORDERS_VIEW}"), available_now=True)
    return as_ntz(_result(spark, work))


QUERIES = {
    "stream_progress": stream_progress,
    "stream_sql_twice": stream_sql_twice,
    "stream_append": stream_append,
    "stream_sql": stream_sql,
    "stream_batch_counts": stream_batch_counts,
    "stream_restart": stream_restart,
    "stream_table_append": stream_table_append,
    "stream_empty_batch": stream_empty_batch,
    "stream_overwrite": stream_overwrite,
    "stream_idempotent": stream_idempotent,
    "console_preview": console_preview,
}

_ROWS = f"SELECT {', '.join(ORDERS_COLS)}, {OP} AS op FROM orders"

ORACLES = {
    "stream_progress": (f"SELECT true AS named, 7 AS kept, count(*) AS n, count(*) AS rows, count(*) FILTER ({OP} = 'c') AS creates, "
                        f"count(*) FILTER ({OP} = 'u') AS updates, count(*) FILTER ({OP} = 'd') AS deletes, 0 AS malformed FROM orders"),
    "stream_sql_twice": f"{_ROWS} UNION ALL {_ROWS}",
    "stream_append": _ROWS,
    "stream_sql": (f"SELECT o_orderkey, o_custkey, o_totalprice, {OP} AS op FROM orders "
                   f"WHERE {OP} <> 'd' AND o_totalprice > 50000"),
    "stream_batch_counts": f"SELECT {OP} AS op, count(*) AS n FROM orders GROUP BY 1",
    "stream_restart": _ROWS,
    # the last file set holds the snapshot reads ('r'): the table keeps those
    "stream_overwrite": _ROWS + f" WHERE {OP} = 'r'",
    "stream_idempotent": _ROWS,
    "stream_table_append": _ROWS,
    "stream_empty_batch": "SELECT count(*) AS n, 1 AS batches FROM orders",
    "console_preview": _ROWS + " ORDER BY o_orderkey LIMIT 20",
}
