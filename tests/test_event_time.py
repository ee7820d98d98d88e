"""Windows, sessions, deduplication, interval joins and late rows across batches and restarts."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql.types import StructType

from tidemark import JobSpec, OutputSpec, SourceSpec, run_job
from tidemark.operators.event_time import interval_join, sessions, with_watermark
from tidemark.operators.parse import parse_changes
from tidemark.session import STATE_ROWS, STATE_STORE, uncounted_state, use_rocksdb
from tidemark.spec import EventTimeSpec
from tidemark.streaming.runner import start_job

T0 = datetime(2024, 5, 1)
SCHEMA = [("id", "long"), ("k", "string"), ("at", "timestamp"), ("v", "double")]


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(STATE_STORE, None)
    use_rocksdb(spark)
    yield
    spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def put(folder, number, rows):
    """One file of records (id, key, minutes, value)."""
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{number:03d}.json", "w") as f:
        for i, k, m, v in rows:
            after = {"id": i, "k": k, "at": None if m is None else (T0 + timedelta(minutes=m)).isoformat(), "v": v}
            f.write(json.dumps({"before": None, "after": after, "op": "c", "ts_ms": 0 if m is None else m * 60_000}) + "\n")
    os.utime(f"{folder}/{number:03d}.json", (1_700_000_000 + number, 1_700_000_000 + number))


def job(tmp, event_time, **out):
    return JobSpec(name=f"timed_{os.path.basename(tmp)}", schema=SCHEMA, envelope={"ts_ms": "bigint"},
                   source=SourceSpec(kind="files", path=f"{tmp}/in", max_files_per_trigger=1),
                   output=OutputSpec(path=f"{tmp}/out", **out), event_time=event_time, checkpoint_location=f"{tmp}/cp")


def minutes(ts):
    return (ts - T0).total_seconds() / 60


def test_windows_close_late_rows_drop_and_state_goes(spark, tmp_path):
    tmp = str(tmp_path)
    spec = job(tmp, EventTimeSpec(column="at", delay="10 minutes", window="1 hour", keys=["k"],
                                  aggregates={"n": "count(*)", "total": "sum(v)"}))
    put(f"{tmp}/in", 0, [(1, "a", 5, 1.0), (2, "a", 50, 2.0), (3, "b", 10, 4.0), (4, None, 20, 8.0), (5, "a", None, 1.0)])
    run_job(spark, spec, available_now=True)
    put(f"{tmp}/in", 1, [(6, "a", 55, 16.0), (7, "a", 90, 1.0)])           # the first hour is still open
    q1 = run_job(spark, spec, available_now=True)
    put(f"{tmp}/in", 2, [(8, "a", 30, 32.0), (9, "a", 200, 1.0)])          # it was closed by the batch before
    q = run_job(spark, spec, available_now=True)
    got = sorted((minutes(r.window_start), r.k or "", r.n, r.total) for r in spark.read.parquet(f"{tmp}/out").collect())
    assert got == [(0.0, "", 1, 8.0), (0.0, "a", 3, 19.0), (0.0, "b", 1, 4.0), (60.0, "a", 1, 1.0)]
    states = [p["stateOperators"][0] for run in (q1, q) for p in run.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 1
    assert states[-1]["numRowsTotal"] == 1                                 # only the open window is left
    assert sum(s["numRowsRemoved"] for s in states) == 4


def test_sliding_windows_by_envelope_time(spark, tmp_path):
    tmp = str(tmp_path)
    spec = job(tmp, EventTimeSpec(column="ts_ms", delay="0 seconds", window="20 minutes", slide="10 minutes",
                                  aggregates={"n": "count(*)"}))
    put(f"{tmp}/in", 0, [(i, "a", i, 1.0) for i in range(1, 40)])
    put(f"{tmp}/in", 1, [(99, "a", 1000, 1.0)])
    run_job(spark, spec, available_now=True)
    got = sorted((r.window_start.timestamp() / 60, r.n) for r in spark.read.parquet(f"{tmp}/out").collect())
    assert got == [(-10.0, 9), (0.0, 19), (10.0, 20), (20.0, 20), (30.0, 10)]


def test_sessions_span_batches_and_restarts(spark, tmp_path):
    tmp = str(tmp_path)
    spec = job(tmp, EventTimeSpec(column="at", delay="1 minute", session_gap="10 minutes", keys=["k"],
                                  aggregates={"n": "count(*)", "last": "max(v)"}))
    for number, rows in enumerate([[(1, "a", 0, 1.0), (2, "b", 3, 1.0)], [(3, "a", 9, 2.0)], [(4, "a", 18, 3.0), (5, "b", 14, 9.0)],
                                   [(6, "c", 500, 1.0)]]):
        put(f"{tmp}/in", number, rows)
        run_job(spark, spec, available_now=True)
    got = sorted((r.k, minutes(r.window_start), minutes(r.window_end), r.n, r.last) for r in spark.read.parquet(f"{tmp}/out").collect())
    assert got == [("a", 0.0, 28.0, 3, 3.0), ("b", 3.0, 13.0, 1, 1.0), ("b", 14.0, 24.0, 1, 9.0)]


def test_dedup_holds_over_restarts_and_forgets_after_the_delay(spark, tmp_path):
    tmp = str(tmp_path)
    spec = job(tmp, EventTimeSpec(column="at", delay="30 minutes", dedup=["id"]))
    sets = [[(1, "a", 0, 1.0), (1, "a", 0, 1.0), (2, "a", 1, 1.0)], [(1, "a", 2, 1.0), (3, "a", 20, 1.0)],
            [(2, "a", 25, 1.0), (4, "a", 300, 1.0)], [(5, "a", 301, 1.0)]]
    last = None
    for number, rows in enumerate(sets):
        put(f"{tmp}/in", number, rows)
        last = run_job(spark, spec, available_now=True)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/out").collect()) == [1, 2, 3, 4, 5]
    states = [p["stateOperators"][0]["numRowsTotal"] for p in last.recentProgress if p["stateOperators"]]
    assert states[-1] == 2                                                 # ids of the last half hour


def test_late_rows_go_to_their_own_sink(spark, tmp_path):
    tmp = str(tmp_path)
    spec = job(tmp, EventTimeSpec(column="at", delay="10 minutes"), late_path=f"{tmp}/late",
               sql=f"select id, v from timed_{os.path.basename(tmp)}")
    sets = [[(1, "a", 0, 1.0), (2, "a", 100, 1.0)], [(3, "a", 89, 1.0), (4, "a", 90, 1.0), (5, "a", None, 1.0)],
            [(6, "a", 95, 1.0), (7, "a", 300, 1.0)], [(8, "a", 200, 1.0)]]
    for number, rows in enumerate(sets):
        put(f"{tmp}/in", number, rows)
        if number % 2:
            run_job(spark, spec, available_now=True)
    on_time, late = spark.read.parquet(f"{tmp}/out"), spark.read.parquet(f"{tmp}/late")
    assert on_time.columns == ["id", "v"] and {"id", "k", "at", "v", "op"} <= set(late.columns)
    assert sorted(r.id for r in on_time.collect()) == [1, 2, 4, 5, 6, 7]
    assert sorted(r.id for r in late.collect()) == [3, 8]
    log = f"{tmp}/cp/tidemark-late/watermark"
    assert [json.load(open(f"{log}/{n}"))["late"] for n in sorted(os.listdir(log)) if n.endswith(".json")] == [0, 1, 0, 1]


def test_a_replayed_batch_is_cut_where_it_was(spark, tmp_path):
    from tidemark.streaming.late import LateRows
    split = LateRows(EventTimeSpec(column="ts_ms", delay="1 second"), str(tmp_path)).split
    rows = lambda *ts: spark.createDataFrame([(t,) for t in ts], "ts_ms long")
    assert [x.count() for x in split(rows(5_000, 1_000), 0)] == [2, 0]
    for _ in range(2):
        assert [x.count() for x in split(rows(3_999, 4_000, 90_000), 1)] == [2, 1]
    assert [x.count() for x in split(rows(), 2)] == [0, 0]
    assert [x.count() for x in split(rows(88_999, 89_000), 3)] == [1, 1]


@pytest.mark.parametrize("how,salts", [("inner", 1), ("inner", 3), ("left_outer", 1), ("left_outer", 3)])
def test_interval_join_on_bounded_frames(spark, how, salts):
    left = spark.createDataFrame([(i, i % 3, T0 + timedelta(minutes=i)) for i in range(30)], "l int, k int, lt timestamp")
    right = spark.createDataFrame([(i, i % 4, T0 + timedelta(minutes=2 * i)) for i in range(12)] , "r int, rk int, rt timestamp")
    got = interval_join(left, right, {"k": "rk"}, "lt", "rt", "-2 minutes", "3 minutes", how=how, salts=salts)
    assert got.columns == ["l", "k", "lt", "r", "rk", "rt"]
    want = [(a, b) for a in range(30) for b in range(12) if a % 3 == b % 4 and -2 <= 2 * b - a <= 3]
    if how == "left_outer":
        want += [(a, None) for a in range(30) if a not in {x for x, _ in want}]
    assert sorted((r.l, r.r if r.r is not None else -1) for r in got.collect()) == sorted((a, -1 if b is None else b) for a, b in want)


@pytest.mark.parametrize("how", ["inner", "left_outer"])
def test_a_restarted_join_fetches_its_state_as_files(spark, tmp_path, how, rocksdb):
    """No log of changes is applied anew, and a state partition is one store."""
    tmp = str(tmp_path)
    line = lambda names, row: json.dumps({"before": None, "after": dict(zip(names, row)), "op": "c"}) + "\n"
    sides = {"l": (["l", "k", "lt"], "l long, k long, lt timestamp"), "r": (["r", "rk", "rt"], "r long, rk long, rt timestamp")}
    minute = lambda m: (T0 + timedelta(minutes=m)).isoformat()
    sets = [([(1, 1, minute(0)), (2, 2, minute(1))], [(7, 2, minute(2))]), ([(3, 3, minute(30))], [(8, 1, minute(4)), (9, 3, minute(90))]),
            ([(4, 4, minute(900))], [(10, 5, minute(900))])]
    for number, rows in enumerate(sets):
        frames = []
        for (name, (names, ddl)), made in zip(sides.items(), rows):
            os.makedirs(f"{tmp}/{name}", exist_ok=True)
            with open(f"{tmp}/{name}/{number}.json", "w") as f:
                f.writelines(line(names, row) for row in made)
            schema = [{"name": f.name, "type": f.dataType.simpleString()} for f in StructType.fromDDL(ddl)]
            raw = spark.readStream.format("text").load(f"{tmp}/{name}")
            frames.append(with_watermark(parse_changes(raw, schema).drop("op"), names[2], "1 hour"))
        with uncounted_state(spark):
            q = (interval_join(*frames, {"k": "rk"}, "lt", "rt", "0 minutes", "10 minutes", how=how).writeStream
                 .format("parquet").outputMode("append").option("checkpointLocation", f"{tmp}/cp")
                 .trigger(availableNow=True).start(f"{tmp}/out"))
        q.awaitTermination()
    assert spark.conf.get(STATE_ROWS, "true") == "true"
    want = [(1, 8), (2, 7)] + ([(3, -1)] if how == "left_outer" else [])
    assert sorted((r.l, r.r if r.r is not None else -1) for r in spark.read.parquet(f"{tmp}/out").collect()) == want
    files = [os.path.join(folder, n) for folder, _, names in os.walk(f"{tmp}/cp/state/0") for n in names]
    assert any(n.endswith(".zip") for n in files) and not any(n.endswith(".changelog") for n in files)
    assert not any("keyWithIndexToValue" in n or "keyToNumValues" in n for n in files)


def test_settings_without_meaning_are_refused(spark, tmp_path):
    tmp = str(tmp_path)
    put(f"{tmp}/in", 0, [(1, "a", 0, 1.0)])
    agg = {"n": "count(*)"}
    for event_time, out in [(EventTimeSpec(column="at", window="1 hour", aggregates=agg), {"late_path": f"{tmp}/late"}),
                            (EventTimeSpec(column="at", window="1 hour", session_gap="1 hour", aggregates=agg), {}),
                            (EventTimeSpec(column="at", window="1 hour"), {}), (EventTimeSpec(column="k", window="1 hour", aggregates=agg), {})]:
        with pytest.raises(ValueError):
            start_job(spark, job(tmp, event_time, **out))
    df = spark.createDataFrame([(1, T0)], "a int, t timestamp")
    with pytest.raises(ValueError):
        interval_join(df, df, {"a": "a"}, "t", "t", "0 days", "1 day")
    assert sessions(with_watermark(df, "t", "1 day"), "t", "1 hour", keys=["a"], aggregates={"n": "count(*)"}).first().n == 1
    spec = JobSpec.from_dict({"name": "x", "event_time": {"column": "ts_ms", "delay": "1 hour", "dedup": ["id"]}})
    assert spec.event_time.stateful and JobSpec.from_dict({"name": "x"}).event_time is None
