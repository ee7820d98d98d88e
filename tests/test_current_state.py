"""The current-state table: latest change per key, untouched buckets, replay, truncate."""

import random

import pytest

from tidemark import JobSpec, OutputSpec, SourceSpec, parse_changes, run_job
from tidemark.sinks.current import Folder, current_version, expire, merge_changes, read_current

CHANGE = "id long, name string, amt double, op string, ts_ms long, pos long"


def plain(changes):
    """The table that the changes leave, whatever order they came in."""
    cut = max(((c[4] is not None, c[4] or 0, c[5] is not None, c[5] or 0) for c in changes if c[3] == "t"), default=None)
    best = {}
    for c in changes:
        at = (c[4] is not None, c[4] or 0, c[5] is not None, c[5] or 0)
        if c[3] is None or c[3] == "t" or (cut is not None and at <= cut):
            continue
        if c[0] not in best or at > best[c[0]][0]:
            best[c[0]] = (at, c)
    return sorted((c[:4] for _, c in best.values() if c[3] != "d"), key=str)


def state(spark, path):
    return sorted((tuple(r)[:4] for r in read_current(spark, path).collect()), key=str)


def merge(spark, path, rows, **kw):
    return merge_changes(spark.createDataFrame(rows, CHANGE), path, ["id"], ["ts_ms", "pos"], **{"buckets": 8, **kw})


def history(seed, n=300, keys=40):
    r = random.Random(seed)
    seen = set()
    rows = []
    while len(rows) < n:
        at = (r.randrange(60), r.randrange(5))
        k = None if r.random() < 0.03 else (0 if r.random() < 0.3 else r.randrange(keys))
        if (k, at) in seen:
            continue
        seen.add((k, at))
        rows.append((k, f"n{r.randrange(9)}", float(r.randrange(100)), r.choice("cuuudr"), *at))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_and_twice(spark, tmp_path, seed):
    rows = history(seed)
    r = random.Random(seed)
    parts = [rows[i::5] for i in range(5)]
    path = str(tmp_path / "t")
    for k, part in enumerate([parts[3], parts[0], parts[3], parts[4], parts[1], r.sample(rows, 60), parts[2]]):
        merge(spark, path, part)
        assert current_version(spark, path).number == k
    assert state(spark, path) == plain(rows)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    first = merge(spark, path, [(k, "a", 1.0, "c", 1, k) for k in range(200)])
    assert len(first.folders) == 8
    second = merge(spark, path, [(7, "b", 2.0, "u", 2, 0), (7, "c", 3.0, "u", 3, 0)])
    changed = [b for b in first.folders if first.folders[b] != second.folders[b]]
    assert len(changed) == 1
    # the older version still reads what it read, until it expires
    assert read_current(spark, path, first).filter("id = 7").first().name == "a"
    assert read_current(spark, path).filter("id = 7").first().name == "c"
    assert read_current(spark, path).count() == 200
    assert expire(spark, path, keep=2) == []
    third = merge(spark, path, [(k, "z", 1.0, "d", 9, k) for k in range(200)])
    assert state(spark, path) == [] and len(third.folders) == 8
    assert len(expire(spark, path, keep=1)) == 2
    merge(spark, path, [(3, "late", 1.0, "u", 8, 0), (3, "back", 1.0, "c", 10, 0)])       # the delete at 9 is remembered
    assert state(spark, path) == [(3, "back", 1.0, "c")]


def test_a_batch_handed_over_again_is_not_merged_again(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a", 1.0, "c", 1, 0)]
    assert merge(spark, path, rows, query_id="q", batch_id=0).number == 0
    assert merge(spark, path, rows, query_id="q", batch_id=0).number == 0
    assert merge(spark, path, rows, query_id="other", batch_id=0).number == 1
    # a commit that never happened leaves files that nobody reads, and they go
    Folder(spark, path).put("data/left-behind/part", "x")
    assert state(spark, path) == [(1, "a", 1.0, "c")]
    assert "left-behind" in expire(spark, path)


def test_truncate_hides_what_is_not_later(spark, tmp_path):
    path = str(tmp_path / "t")
    one = [(1, "a", 1.0, "c", 5, 0), (2, "b", 1.0, "c", 9, 0)]
    two = [(None, None, None, "t", 7, 0), (3, "c", 1.0, "c", 7, 1), (4, "d", 1.0, "c", 7, 0)]
    three = [(5, "late", 1.0, "c", 6, 0), (1, "again", 1.0, "c", 8, 0), (None, None, None, "t", 2, 0)]
    for part in (one, two, three):
        merge(spark, path, part)
    assert state(spark, path) == plain(one + two + three) == [(1, "again", 1.0, "c"), (2, "b", 1.0, "c"), (3, "c", 1.0, "c")]


def test_ties_nulls_malformed_and_empty(spark, tmp_path):
    rows = [(1, "a", 1.0, "u", 5, 0), (1, "b", 2.0, "u", 5, 0)]
    got = []
    for k, order in enumerate((rows, rows[::-1])):
        path = str(tmp_path / f"t{k}")
        for r in order:
            merge(spark, path, [r])
        got.append(state(spark, path))
    assert got[0] == got[1] and len(got[0]) == 1           # equal orders: the same one wins either way
    path = str(tmp_path / "odd")
    merge(spark, path, [(None, None, None, None, None, None), (None, "x", 1.0, "c", None, None), (None, "y", 1.0, "c", 0, None)])
    assert state(spark, path) == [(None, "y", 1.0, "c")]
    assert merge(spark, path, []).number == 1 and len(state(spark, path)) == 1
    empty = str(tmp_path / "empty")
    merge(spark, empty, [])
    assert read_current(spark, empty).columns == ["id", "name", "amt", "op", "ts_ms", "pos"] and state(spark, empty) == []
    with pytest.raises(ValueError):
        read_current(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        merge_changes(spark.createDataFrame([], CHANGE), path, ["name"], ["ts_ms", "pos"])
    with pytest.raises(ValueError):
        merge_changes(spark.createDataFrame([], CHANGE).drop("pos"), path, ["id"], ["ts_ms", "pos"])
    with pytest.raises(FileExistsError):
        Folder(spark, path).put("versions/00000000000000000000.json", "{}")


def test_envelope_values_beside_the_images(spark):
    recs = ['{"after":{"a":1},"op":"c","ts_ms":5,"source":{"pos":9}}', '{"after":{"a":1},"op":"c","ts_ms":"6"}',
            '{"after":{"a":1},"op":7,"ts_ms":5}', "no json", '{"before":{"a":2},"op":"d","ts_ms":"x","source":[1]}']
    got = parse_changes(spark.createDataFrame([(r,) for r in recs], "value string"), [("a", "int")],
                        envelope={"ts_ms": "bigint", "source.pos": "bigint"})
    assert got.columns == ["a", "op", "ts_ms", "pos"]
    assert [tuple(r) for r in got.collect()] == [(1, "c", 5, 9), (1, "c", 6, None), (None, None, None, None),
                                                 (None, None, None, None), (2, "d", None, None)]
    with pytest.raises(ValueError):
        parse_changes(got, [("ts_ms", "long")], envelope={"ts_ms": "bigint"})


def test_declared_job_keeps_a_table(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spec = JobSpec.from_dict({
        "name": "keeper", "schema": [{"name": "id", "type": "long"}, {"name": "amt", "type": "double"}],
        "envelope": {"ts_ms": "bigint"}, "source": {"kind": "files", "path": src, "max_files_per_trigger": 1},
        "output": {"path": out, "upsert_keys": ["id"], "upsert_order": ["ts_ms"], "buckets": 4},
        "checkpoint_root": str(tmp_path)})
    rec = lambda i, amt, op, ts: (f'{{"before":{{"id":{i}}},"after":{{"id":{i},"amt":{amt}}},"op":"{op}","ts_ms":{ts}}}',)
    for rows in ([rec(1, 1, "c", 1), rec(2, 1, "c", 1)], [rec(1, 9, "u", 3), rec(2, 0, "d", 2)], [rec(1, 5, "u", 2), ("bad",)]):
        spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(src)
        run_job(spark, spec, available_now=True)
    assert [(r.id, r.amt) for r in read_current(spark, out).collect()] == [(1, 9.0)]
    with pytest.raises(ValueError):
        run_job(spark, JobSpec(name="x", output=OutputSpec(upsert_keys=["id"]), source=SourceSpec(kind="files", path=src),
                               checkpoint_root=str(tmp_path)), available_now=True)
