"""Broken chains (stateful processor), schema evolution and mergeable sketches."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import JobSpec, OutputSpec, SourceSpec, run_job
from tidemark.operators.sketches import estimates, hll_error, kll_error, merge_sketches, sketch
from tidemark.session import ROCKSDB_STATE_STORE, STATE_STORE, use_rocksdb
from tidemark.sinks.evolve import SchemaChangeError, evolved, read_evolved, table_schema, write_evolving
from tidemark.streaming.chains import broken_chains


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(STATE_STORE, None)
    use_rocksdb(spark)
    yield
    spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def test_broken_chains_across_batches_and_restarts(spark, tmp_path, rocksdb):
    tmp = str(tmp_path)
    assert spark.conf.get(STATE_STORE) == ROCKSDB_STATE_STORE
    os.makedirs(f"{tmp}/in")
    img = lambda k, v: None if v is None else {"v": v, "k": k}

    def put(number, rows):
        with open(f"{tmp}/in/{number}.json", "w") as f:
            for k, at, pos, op, before, after in rows:
                f.write(json.dumps({"before": img(k, before), "after": img(k, after), "op": op, "ts_ms": at, "source": {"pos": pos}}) + "\n")
        raw = spark.readStream.format("text").load(f"{tmp}/in")
        q = (broken_chains(raw, "k", "10 seconds").writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{tmp}/cp").trigger(availableNow=True).start(f"{tmp}/out"))
        q.awaitTermination()

    put(0, [("a", 1000, 1, "c", None, 1), ("b", 1000, 2, "u", 7, 8), ("c", 1000, 3, "c", None, 1), ("c", 1000, 4, "d", 1, None)])
    put(1, [("a", 3000, 6, "u", 2, 3), ("b", 2000, 5, "u", 9, 10), ("c", 2000, 7, "u", 1, 2)])       # a's 2 is still to come
    put(2, [("a", 2000, 5, "u", 1, 2), ("a", 3000, 7, "u", 3, 3), ("b", 9000, 9, "c", None, 4), ("z", 30_000, 1, "c", None, 1)])
    put(3, [("a", 40_000, 1, "u", 4, 5), ("b", 41_000, 1, "u", 4, 5), ("z", 90_000, 2, "d", 1, None)])
    put(4, [("z", 200_000, 3, "c", None, 1), (None, 200_000, 3, "c", None, 1)])
    got = sorted(map(tuple, spark.read.parquet(f"{tmp}/out").collect()))
    # b's first change has nothing before it; c's update comes after its delete
    assert got == [("a", 40_000, 1, "u"), ("b", 2000, 5, "u"), ("c", 2000, 7, "u")]


def test_chains_of_many_keys_are_walked_by_bucket(spark, tmp_path, rocksdb):
    """A call and a state row a bucket, not a key; each key's chain is its own."""
    tmp, keys = str(tmp_path), 300
    os.makedirs(f"{tmp}/in")
    states = []
    for number, value in enumerate((0, 2, 1, 9)):       # the second changes come before the first
        with open(f"{tmp}/in/{number}.json", "w") as f:
            for k in range(keys):
                before = value - 1 + (0.5 if k % 7 == 0 and value == 2 else 0)
                f.write(json.dumps({"before": {"k": k, "v": before} if value else None, "after": {"k": k, "v": value},
                                    "op": "u" if value else "c", "ts_ms": 1000 + value * 10_000 + k, "source": {"pos": value}}) + "\n")
        raw = spark.readStream.format("text").load(f"{tmp}/in")
        q = (broken_chains(raw, "k", "15 seconds", buckets=5).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{tmp}/cp").trigger(availableNow=True).start(f"{tmp}/out"))
        q.awaitTermination()
        states += [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    got = sorted(map(tuple, spark.read.parquet(f"{tmp}/out").collect()))
    assert got == sorted((str(k), 21_000 + k, 2, "u") for k in range(0, keys, 7))
    assert max(states) == 5


def schema(text):
    return StructType.fromDDL(text)


@pytest.mark.parametrize("old,new,want", [
    ("a int", "a int, b string", "a int, b string"), ("a int, b string", "b string", "a int, b string"),
    ("a int, f float", "f double, A bigint", "a bigint, f double"), ("", "a int", "a int"), ("a int", "a double", "a double")])
def test_schemas_grow(old, new, want):
    assert evolved(schema(old) if old else StructType([]), schema(new)).simpleString() == schema(want).simpleString()


@pytest.mark.parametrize("old,new", [("a bigint", "a int"), ("a string", "a int"), ("a int", "a string"), ("a double", "a float"),
                                     ("a timestamp", "a date"), ("a int", "a int, A int")])
def test_other_changes_are_refused(old, new):
    with pytest.raises(SchemaChangeError):
        evolved(schema(old), schema(new))


def test_one_table_over_three_shapes(spark, tmp_path):
    out = OutputSpec(path=str(tmp_path / "t"), evolve=True)
    write_evolving(spark.createDataFrame([(1, 0.5)], "a int, f float"), out)
    write_evolving(spark.createDataFrame([("x", 2 ** 40, 0.25)], "s string, a long, f double"), out)
    write_evolving(spark.createDataFrame([("y",)], "S string"), out)
    with pytest.raises(SchemaChangeError):
        write_evolving(spark.createDataFrame([(1,)], "a int"), out)
    got = read_evolved(spark, out.path)
    assert got.schema.simpleString() == "struct<a:bigint,f:double,s:string>"
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, 0.5, None), (2 ** 40, 0.25, "x"), (None, None, "y")]))
    assert table_schema(spark, str(tmp_path / "none")) is None
    with pytest.raises(ValueError):
        write_evolving(got, OutputSpec(path=out.path, write_mode="overwrite"))


def test_a_restarted_job_with_more_fields(spark, tmp_path):
    tmp = str(tmp_path)
    def run(number, fields, record):
        os.makedirs(f"{tmp}/in", exist_ok=True)
        with open(f"{tmp}/in/{number}.json", "w") as f:
            f.write(json.dumps({"after": record, "op": "c"}) + "\n")
        run_job(spark, JobSpec(name="grown", schema=fields, source=SourceSpec(kind="files", path=f"{tmp}/in"),
                               output=OutputSpec(path=f"{tmp}/out", evolve=True, idempotent=True),
                               checkpoint_location=f"{tmp}/cp"), available_now=True)
    run(0, [("a", "int")], {"a": 1, "b": "lost"})
    run(1, [("a", "long"), ("b", "string"), ("d", "date")], {"a": 2 ** 33, "b": "x", "d": "2024-01-02"})
    got = read_evolved(spark, f"{tmp}/out").orderBy("a").collect()
    assert [(r.a, r.b, str(r.d), r.op) for r in got] == [(1, None, "None", "c"), (2 ** 33, "x", "2024-01-02", "c")]
    with pytest.raises(Exception, match="narrow|widened"):
        run(2, [("a", "int")], {"a": 3})
    assert read_evolved(spark, f"{tmp}/out").count() == 2


def test_merged_sketches_are_within_their_errors(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 7919).alias("who"),
                                      F.concat(F.lit("u"), F.col("id") % 4001).alias("name"),
                                      F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7).alias("x"))
    parts = None
    for k in range(4):
        s = sketch(rows.filter(F.pmod(F.xxhash64("who", "name"), F.lit(4)) == k), ["g"], ["who", "name"], ["x"])
        parts = s if parts is None else parts.unionByName(s)
    merged = estimates(merge_sketches(parts, ["g"]), {"p10": 0.1, "p50": 0.5, "p99": 0.99})
    whole = estimates(merge_sketches(parts, []), {"p50": 0.5}).first()
    exact = {r.g: r for r in rows.groupBy("g").agg(F.count("*").alias("rows"), F.countDistinct("who").alias("who"),
                                                  F.countDistinct("name").alias("name")).collect()}
    for r in merged.collect():
        e = exact[r.g]
        assert r.rows == e.rows
        assert abs(r.who_distinct - e.who) <= hll_error() * e.who and abs(r.name_distinct - e.name) <= hll_error() * e.name
        group = rows.filter((F.col("g") == r.g) & F.col("x").isNotNull())
        for share, value in ((0.1, r.x_p10), (0.5, r.x_p50), (0.99, r.x_p99)):
            assert abs(group.filter(F.col("x") <= value).count() / group.count() - share) <= kll_error()
    assert whole.rows == 60_000 and abs(whole.who_distinct - 7919) <= hll_error() * 7919
    assert sketch(rows.filter("false"), ["g"], ["who"], ["x"]).count() == 0
    nulls = spark.createDataFrame([("a", None, None)], "g string, who long, x double")
    got = estimates(sketch(nulls, ["g"], ["who"], ["x"])).first()
    assert got.rows == 1 and got.who_distinct == 0
    with pytest.raises(ValueError):
        sketch(rows, ["g"], quantiles=["name"])
