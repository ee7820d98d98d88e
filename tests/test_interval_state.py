"""The state of a stream-stream interval join is kept by bucket, with the rows of Spark's own join."""

import glob
import json
import os
import random
import tempfile
from datetime import datetime, timedelta

import pyarrow as pa
import pytest

from conftest import SF_SMALL
from tidemark.operators.event_time import interval_join, with_watermark
from tidemark.operators.interval_state import can_keep_by_bucket
from tidemark.operators.parse import parse_changes
from tidemark.registry import stateful
from tidemark.session import ONE_COPY, SHUFFLE_CLEANUP, STATE_STORE, use_rocksdb

T0 = datetime(2024, 5, 1)
LEFT = [("l", "long"), ("k", "long"), ("n", "string"), ("lt", "timestamp")]
RIGHT = [("r", "long"), ("rk", "long"), ("rn", "string"), ("rt", "timestamp")]
FAR = 5_000_000


@pytest.fixture(autouse=True)
def rocksdb(spark):
    before = spark.conf.get(STATE_STORE, None)
    use_rocksdb(spark)
    yield
    spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def put(folder, number, names, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{number:03d}.json", "w") as f:
        for row in rows:
            after = dict(zip(names, [*row[:-1], (T0 + timedelta(minutes=row[-1])).isoformat() + "Z"]))
            f.write(json.dumps({"before": None, "after": after, "op": "c"}) + "\n")


def sides(spark, tmp):
    return [with_watermark(parse_changes(spark.readStream.format("text").load(f"{tmp}/{name}"), schema).drop("op"), schema[-1][0], "1 hour")
            for name, schema in (("l", LEFT), ("r", RIGHT))]


def run(spark, tmp, sets, on, first=0, **kw):
    """A restart after every set of (left rows, right rows); the pairs, and the rows of state seen."""
    seen = []
    for number, (left, right) in enumerate(sets, first):
        put(f"{tmp}/l", number, [n for n, _ in LEFT], left)
        put(f"{tmp}/r", number, [n for n, _ in RIGHT], right)
        q = (interval_join(*sides(spark, tmp), on, "lt", "rt", "-5 minutes", "10 minutes", **kw).writeStream.format("parquet")
             .outputMode("append").option("checkpointLocation", f"{tmp}/cp").trigger(availableNow=True).start(f"{tmp}/out"))
        q.awaitTermination()
        seen += [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    out = spark.read.parquet(f"{tmp}/out")
    assert out.columns == [n for n, _ in LEFT + RIGHT] and [t for _, t in out.dtypes] == ["bigint", "bigint", "string", "timestamp"] * 2
    return sorted(((r.l, r.r) for r in out.collect()), key=str), seen


@pytest.mark.parametrize("how,salts,on", [("inner", 3, {"k": "rk", "n": "rn"}), ("left_outer", 1, {"k": "rk"}),
                                          ("left_outer", 2, {"n": "rn"})])
def test_all_pairs_once_and_a_state_row_a_bucket(spark, tmp_path, how, salts, on):
    rnd = random.Random(7)
    big = 2**60         # whole numbers stay exact beside nulls
    row = lambda i, m: (big + i, rnd.choice([None, *range(big, big + 6)]), rnd.choice([None, "", "a", "é", "a1"]), m)
    sets = []
    for number in range(3):
        at = lambda: number * 20 + rnd.randrange(40)
        sets.append(([row(100 * number + i, at()) for i in range(60)], [row(100 * number + i, at()) for i in range(60)]))
    left, right = [r for s in sets for r in s[0]], [r for s in sets for r in s[1]]
    sets.append(([(0, None, None, FAR)], [(0, None, None, FAR)]))
    where = [([n for n, _ in LEFT].index(a), [n for n, _ in RIGHT].index(b)) for a, b in on.items()]
    want = [(x[0], y[0]) for x in left for y in right
            if -5 <= y[-1] - x[-1] <= 10 and all(x[a] is not None and x[a] == y[b] for a, b in where)]
    if how == "left_outer":
        paired = {a for a, _ in want}
        want += [(x[0], None) for x in left if x[0] not in paired]
    got, seen = run(spark, str(tmp_path), sets, on, how=how, salts=salts, buckets=4)
    assert len(want) > 100 and got == sorted(want, key=str)
    assert 0 < max(seen) <= 4


def test_late_rows_are_dropped_and_a_time_far_ahead_is_taken(spark, tmp_path):
    ahead = 2_000_000_000          # minutes; beyond 2262
    sets = [([(1, 1, "a", 0), (2, 2, "b", 1)], [(7, 2, "b", 2)]), ([(3, 3, "c", 900)], [(8, 3, "c", 901)]),
            ([(4, 1, "late", 3), (5, 3, "c", 902)], [(9, 1, "late", 3), (10, 3, "c", 899)]),
            ([(6, 4, "d", ahead)], [(11, 4, "d", ahead + 1)]), ([(12, 9, "e", ahead + 200)], [(13, 9, "f", ahead + 200)])]
    got, _ = run(spark, str(tmp_path), sets, {"k": "rk"}, how="left_outer", buckets=2)
    assert got == sorted([(1, None), (2, 7), (3, 8), (3, 10), (5, 8), (5, 10), (6, 11), (12, 13)], key=str)


def test_a_restart_in_another_time_zone(spark, tmp_path):
    sets = [([(1, 1, "a", 0), (2, 2, "b", 0)], [(7, 2, "b", 2)])], [([(3, 2, "c", 5)], [(8, 1, "a", 9)]), ([(9, 9, "x", FAR)], [(9, 8, "x", FAR)])]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        run(spark, str(tmp_path), sets[0], {"k": "rk"}, how="left_outer", buckets=2)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got, _ = run(spark, str(tmp_path), sets[1], {"k": "rk"}, 1, how="left_outer", buckets=2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [(1, 8), (2, 7), (3, 7)]


def test_what_does_not_fit_is_left_to_sparks_own_state(spark, tmp_path):
    for name in ("l", "r"):
        os.makedirs(f"{tmp_path}/{name}")
    left, right = sides(spark, tmp_path)
    fits = lambda a, b, on, upper="10 minutes": can_keep_by_bucket(a, b, on, "lt", "rt", "0 minutes", upper)
    assert fits(left, right, [("k", "rk")]) and fits(left, right, [("n", "rn"), ("k", "rk")])
    assert not fits(left, right, [("k", "rn")]) and not fits(left, right, [("k", "rk")], "1 month")
    still = spark.createDataFrame([], "r long, rk long, rn string, rt timestamp")
    assert not fits(left, still, [("k", "rk")])


def held(spark, checkpoint):
    """The blocks of the state as Arrow tables: left ones, right ones."""
    rows = spark.read.format("statestore").load(checkpoint).select("value.groupState.*").collect()
    return [[pa.ipc.open_stream(bytes(r[side])).read_all() for r in rows if r[side] is not None] for side in ("left", "right")]


def test_state_holds_the_rows_own_columns_in_the_order_of_their_key(spark, tmp_path):
    """A left row once, a right row once a salt, in blocks without a key or salt beside them."""
    rnd = random.Random(3)
    rows = lambda: [(i, rnd.randrange(40), "a", 5) for i in range(300)]
    left, right = rows(), rows()
    got, _ = run(spark, str(tmp_path), [(left, right)], {"k": "rk"}, how="inner", salts=3, buckets=8)
    assert got == sorted(((x[0], y[0]) for x in left for y in right if x[1] == y[1]), key=str)
    for tables, columns, key, copies in zip(held(spark, f"{tmp_path}/cp"), (LEFT, RIGHT), ("k", "rk"), (1, 3)):
        assert {c for t in tables for c in t.column_names} - {"tidemark_matched"} == {n for n, _ in columns}
        assert sum(t.num_rows for t in tables) == 300 * copies
        assert all(t.column(key).to_pylist() == sorted(t.column(key).to_pylist()) for t in tables)


def test_more_salts_than_buckets_and_keys_of_two_widths(spark, tmp_path):
    rnd = random.Random(5)
    sets = [([(100 * n + i, rnd.choice([None, *range(4)]), "a", 10 * n + rnd.randrange(20)) for i in range(40)],
             [(100 * n + i, rnd.choice([None, *range(4)]), "a", 10 * n + rnd.randrange(20)) for i in range(40)]) for n in range(2)]
    left, right = [r for s in sets for r in s[0]], [r for s in sets for r in s[1]]
    sets.append(([(999, None, None, FAR)], [(999, None, None, FAR)]))
    want = [(x[0], y[0]) for x in left for y in right if x[1] is not None and x[1] == y[1] and -5 <= y[-1] - x[-1] <= 10]
    want += [(x[0], None) for x in left if x[0] not in {a for a, _ in want}]
    before = list(RIGHT)
    try:
        RIGHT[1] = ("rk", "int")
        for number, (some, others) in enumerate(sets):
            put(f"{tmp_path}/l", number, [n for n, _ in LEFT], some)
            put(f"{tmp_path}/r", number, [n for n, _ in RIGHT], others)
            (interval_join(*sides(spark, tmp_path), {"k": "rk"}, "lt", "rt", "-5 minutes", "10 minutes", how="left_outer", salts=9, buckets=4)
             .writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp")
             .trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination())
    finally:
        RIGHT[:] = before
    assert sorted(((r.l, r.r) for r in spark.read.parquet(f"{tmp_path}/out").collect()), key=str) == sorted(want, key=str)


def test_the_query_leaves_one_copy_of_what_it_keeps(spark, tmp_path, monkeypatch):
    """Feeds are compressed, and old versions of the state do not stay in the checkpoint."""
    work = f"{tmp_path}/work"
    monkeypatch.setattr(stateful, "_workdir", lambda *_: work)
    local = lambda: set(glob.glob(f"{tempfile.gettempdir()}/spark-*/**/StateStoreId*", recursive=True))
    names = [*ONE_COPY, *SHUFFLE_CLEANUP]
    before, at_first = {k: spark.conf.get(k, None) for k in names}, local()
    assert stateful.stream_interval_join(spark, SF_SMALL).count() > 0
    assert {k: spark.conf.get(k, None) for k in names} == before
    plain = [n for side in ("orders", "lines") for n in glob.glob(f"{work}/{side}/*.txt")]
    assert sum(len(open(n).readlines()) for n in plain) == 2        # the heartbeats
    stores = glob.glob(f"{work}/checkpoint/state/0/[0-9]*")
    assert stores and all(len(glob.glob(f"{s}/*.zip")) <= 2 for s in stores)
    assert local() <= at_first
