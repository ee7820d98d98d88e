"""The streaming job: stream = batch, per-batch SQL, restart, replay, console, metrics."""

import json
import os

from pyspark.sql import functions as F

from tidemark import JobSpec, OutputSpec, SourceSpec, parse_changes, run_job, start_job
from tidemark.streaming.runner import job_checkpoint, query_name

SCHEMA = [("id", "long"), ("amt", "double")]


def write_files(folder, start, n_files, per_file=25):
    os.makedirs(folder, exist_ok=True)
    for f in range(start, start + n_files):
        with open(os.path.join(folder, f"part-{f:03d}.json"), "w") as fh:
            for i in range(f * per_file, (f + 1) * per_file):
                op = "cud"[i % 3]
                img = {"id": i, "amt": i + 0.25}
                rec = {"before": img if op == "d" else None, "after": None if op == "d" else img,
                       "source": {"db": "db", "table": "t"}, "op": op, "ts_ms": 1000 * i}
                fh.write(json.dumps(rec) + "\n")


def job(tmp, **out):
    return JobSpec(name="changes", schema=SCHEMA,
                   source=SourceSpec(kind="files", path=f"{tmp}/in", max_files_per_trigger=1),
                   output=OutputSpec(path=f"{tmp}/out", **out),
                   checkpoint_location=f"{tmp}/cp")


def test_stream_equals_batch(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 4)
    q = run_job(spark, job(tmp), available_now=True)
    streamed = spark.read.parquet(f"{tmp}/out")
    batch = parse_changes(spark.read.text(f"{tmp}/in"), SCHEMA)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert len(q.recentProgress) >= 4  # one file per micro-batch
    metrics = [p["observedMetrics"]["cdc_rows"] for p in q.recentProgress if p["numInputRows"] > 0]
    assert sum(int(m["rows"]) for m in metrics) == 100
    assert sum(int(m["deletes"]) for m in metrics) == 33


def test_per_batch_sql_meaning(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 4)
    run_job(spark, job(tmp, sql="select op, count(*) as n from changes group by op"),
            available_now=True)
    rows = spark.read.parquet(f"{tmp}/out").collect()
    assert len(rows) > 3  # one row per op *per batch*, not one per op
    totals = {}
    for r in rows:
        totals[r.op] = totals.get(r.op, 0) + r.n
    assert totals == {"c": 34, "u": 33, "d": 33}


def test_restart_processes_only_new_files(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 2)
    run_job(spark, job(tmp), available_now=True)
    assert spark.read.parquet(f"{tmp}/out").count() == 50
    write_files(f"{tmp}/in", 2, 1)
    run_job(spark, job(tmp), available_now=True)
    out = spark.read.parquet(f"{tmp}/out")
    assert out.count() == 75 and out.select("id").distinct().count() == 75


def _drop_last_commit(cp):
    commits = sorted(int(n) for n in os.listdir(f"{cp}/commits") if n.isdigit())
    last = commits[-1]
    os.remove(f"{cp}/commits/{last}")
    crc = f"{cp}/commits/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)


def test_replay_after_crash_is_at_least_once_by_default(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 2)
    run_job(spark, job(tmp), available_now=True)
    _drop_last_commit(f"{tmp}/cp")  # crash after the write, before the commit
    run_job(spark, job(tmp), available_now=True)
    out = spark.read.parquet(f"{tmp}/out")
    assert out.count() == 75 and out.select("id").distinct().count() == 50


def test_replay_after_crash_is_exactly_once_when_idempotent(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 2)
    run_job(spark, job(tmp, idempotent=True), available_now=True)
    _drop_last_commit(f"{tmp}/cp")
    run_job(spark, job(tmp, idempotent=True), available_now=True)
    out = spark.read.parquet(f"{tmp}/out")
    assert out.count() == 50 and out.select("id").distinct().count() == 50


def test_table_sink_and_refresh(spark, tmp_path):
    tmp = str(tmp_path)
    spark.sql("CREATE DATABASE IF NOT EXISTS stream_ns")
    write_files(f"{tmp}/in", 0, 2)
    spec = JobSpec(name="changes_tbl", schema=SCHEMA,
                   source=SourceSpec(kind="files", path=f"{tmp}/in"),
                   output=OutputSpec(target_table="stream_ns.changes_tbl"),
                   catalog="spark_catalog", checkpoint_location=f"{tmp}/cp")
    spark.sql("DROP TABLE IF EXISTS spark_catalog.stream_ns.changes_tbl")
    run_job(spark, spec, available_now=True)
    assert spark.table("spark_catalog.stream_ns.changes_tbl").count() == 50
    write_files(f"{tmp}/in", 2, 1)
    run_job(spark, spec, available_now=True)
    assert spark.table("spark_catalog.stream_ns.changes_tbl").count() == 75


def test_console_sink_shows_first_rows(spark, tmp_path, capsys):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 1)
    spec = job(tmp, sink="console", sql="select * from changes order by id", console_rows=3)
    run_job(spark, spec, available_now=True)
    shown = capsys.readouterr().out
    table_rows = [line for line in shown.splitlines() if line.startswith("|")]
    assert len(table_rows) == 1 + 3  # header and the first 3 rows by id
    assert [r.split("|")[1].strip() for r in table_rows[1:]] == ["0", "1", "2"]
    assert query_name(spec) == "console_changes"
    assert job_checkpoint(spark, spec) == f"{tmp}/cp"


def test_checkpoint_defaults_to_shared_folder(spark, tmp_path, monkeypatch):
    import pytest
    from tidemark.streaming import runner
    spec = JobSpec(name="j", output=OutputSpec(path=str(tmp_path)))
    monkeypatch.setattr(runner, "checkpoint_setting", lambda s: "/state")     # the same in every application
    assert job_checkpoint(spark, spec) == "/state/checkpoints/j/main"
    monkeypatch.setattr(runner, "checkpoint_setting", lambda s: None)
    with pytest.raises(ValueError, match="no checkpoint folder"):      # not a per-application one
        job_checkpoint(spark, spec)
    spec.checkpoint_root = "s3a://state"
    assert job_checkpoint(spark, spec) == "s3a://state/checkpoints/j/main"


RESTARTED = """
import sys
from pyspark.sql import SparkSession
from tidemark import JobSpec, OutputSpec, SourceSpec, run_job
root, idempotent = sys.argv[1], sys.argv[2] == "yes"
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", root + "/state").getOrCreate())
run_job(spark, JobSpec(name="again", schema=[("id", "long"), ("amt", "double")],
                       source=SourceSpec(kind="files", path=root + "/in", max_files_per_trigger=1),
                       output=OutputSpec(path=root + "/out", idempotent=idempotent)), available_now=True)
spark.stop()
"""


def test_second_application_resumes_at_the_default_place(spark, tmp_path):
    """Two processes, nothing said about checkpoints but spark.checkpoint.dir."""
    import subprocess
    import sys
    from conftest import ROOT
    for mode in ("no", "yes"):
        tmp = str(tmp_path / mode)
        for start, n in ((0, 2), (2, 1)):
            write_files(f"{tmp}/in", start, n)
            done = subprocess.run([sys.executable, "-c", RESTARTED, tmp, mode], cwd=ROOT, timeout=180,
                                  capture_output=True, text=True)
            assert done.returncode == 0, done.stderr[-2000:]
        out = spark.read.parquet(f"{tmp}/out")
        assert sorted(r.id for r in out.select("id").collect()) == list(range(75))


def test_fresh_checkpoint_keeps_rows_of_an_idempotent_table(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 1)
    first = job(tmp, idempotent=True)
    run_job(spark, first, available_now=True)
    write_files(f"{tmp}/other", 1, 1)
    second = job(tmp, idempotent=True)
    second.source.path, second.checkpoint_location = f"{tmp}/other", f"{tmp}/cp2"
    run_job(spark, second, available_now=True)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/out").collect()) == list(range(50))


def test_processing_time_trigger_runs_until_stopped(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 1)
    spec = job(tmp)
    spec.spark.trigger_interval = "200 milliseconds"
    q = start_job(spark, spec)
    try:
        q.processAllAvailable()
        assert spark.read.parquet(f"{tmp}/out").count() == 25
        assert q.isActive and q.name == "streaming_changes"
    finally:
        q.stop()


def test_empty_batch_is_skipped(spark, tmp_path):
    from tidemark import BatchHandler
    out = tmp_path / "never"
    handler = BatchHandler(JobSpec(name="changes", output=OutputSpec(path=str(out), sql="select 1 as x")))
    empty = parse_changes(spark.createDataFrame([], "value string"), SCHEMA)
    handler(empty, 0)
    assert not out.exists()


def test_session_conf_from_spec(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 1)
    spec = job(tmp)
    spec.spark.min_batches_to_retain = 7
    spec.spark.shuffle_partitions = 5
    run_job(spark, spec, available_now=True)
    assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") == "7"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "5"
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "true"
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_batch_error_stops_the_query(spark, tmp_path):
    from pyspark.errors import StreamingQueryException
    import pytest
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 1)
    with pytest.raises(StreamingQueryException):
        run_job(spark, job(tmp, sql="select no_such_column from changes"), available_now=True)


def test_windows_and_functions_in_batch_sql(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 2)
    spec = job(tmp, sql=("select id, op, twice(cast(id as int)) as id2, "
                         "row_number() over (partition by op order by id desc) as rn from changes"))
    spec.functions = {"twice": "(x INT) RETURNS INT RETURN x * 2"}
    run_job(spark, spec, available_now=True)
    rows = spark.read.parquet(f"{tmp}/out").collect()
    assert len(rows) == 50 and all(r.id2 == 2 * r.id for r in rows)
    # one file per micro-batch: the window restarts in every batch
    firsts = sorted(r.id for r in rows if r.rn == 1)
    assert len(firsts) == 6


def test_progress_log_reports_rows_per_batch(spark, tmp_path):
    import time
    from tidemark.streaming import ProgressLog
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 3)
    progress = ProgressLog()
    run_job(spark, job(tmp), available_now=True, progress=progress)
    deadline = time.time() + 10  # listener events arrive asynchronously
    while sum(b["rows"] for b in progress.batches) < 75 and time.time() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(progress)
    with_rows = [b for b in progress.batches if b["rows"]]
    assert sum(b["rows"] for b in with_rows) == 75
    assert all(int(b["metrics"]["cdc_rows"]["rows"]) == b["rows"] for b in with_rows)


def test_lookup_tables_visible_in_micro_batches(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 2)
    spark.createDataFrame([("c", "create"), ("u", "update"), ("d", "delete")], "op string, label string") \
        .write.parquet(f"{tmp}/ops")
    spec = job(tmp, sql="select c.id, o.label from changes c join op_labels o on c.op = o.op")
    spec.lookup_tables = {"op_labels": f"{tmp}/ops"}
    run_job(spark, spec, available_now=True)
    rows = spark.read.parquet(f"{tmp}/out").collect()
    assert len(rows) == 50
    assert {r.label for r in rows} == {"create", "update", "delete"}


def test_backfill_matches_stream(spark, tmp_path):
    from tidemark.plans import backfill_frame
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 3)
    spec = job(tmp, sql="select id, amt, op from changes where op <> 'd'")
    run_job(spark, spec, available_now=True)
    streamed = sorted(map(tuple, spark.read.parquet(f"{tmp}/out").collect()))
    assert streamed == sorted(map(tuple, backfill_frame(spark, spec).collect()))
    assert len(streamed) == 50


def test_record_operators_on_a_streaming_frame(spark, tmp_path):
    from tidemark import conform, filter_by_operation, lift_metadata
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 2)
    raw = spark.readStream.format("text").load(f"{tmp}/in")
    out = conform(parse_changes(filter_by_operation(lift_metadata(raw), ["c", "u"]).drop("op", "ts_ms"),
                                SCHEMA, keep=["source_table"]),
                  [("id", "long"), ("source_table", "string"), ("op", "string")])
    assert out.isStreaming
    q = (out.writeStream.format("memory").queryName("ops_stream")
            .option("checkpointLocation", f"{tmp}/cp").trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.sql("select * from ops_stream").collect()
    assert len(rows) == 34  # the creates and updates among the 50 records
    assert {r.op for r in rows} == {"c", "u"} and {r.source_table for r in rows} == {"t"}


def test_source_columns_carried_for_per_batch_sql(spark, tmp_path):
    tmp = str(tmp_path)
    write_files(f"{tmp}/in", 0, 1)
    spec = job(tmp, sql="select id, op, length(value) > 0 as has_raw from changes")
    spec.source.keep_columns = ["value"]
    run_job(spark, spec, available_now=True)
    rows = spark.read.parquet(f"{tmp}/out").collect()
    assert len(rows) == 25 and all(r.has_raw for r in rows)
