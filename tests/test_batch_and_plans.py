"""Per-batch SQL, column selection, lookup joins, and the shape of the plans."""

import pytest
from pyspark.sql import functions as F

from helpers import plan_text
from tidemark import JobSpec, OutputSpec, apply_batch, parse_changes, run_sql, select_columns
from tidemark.plans.batch import materialize
from tidemark.streaming.runner import register_lookup_tables

RECS = [('{"after":{"id":%d,"cust":%d,"amt":%d.5},"op":"%s"}' % (i, i % 3, i, "cdu"[i % 3]),)
        for i in range(30)]
SCHEMA = [("id", "long"), ("cust", "long"), ("amt", "double")]


def parsed(spark):
    return parse_changes(spark.createDataFrame(RECS, "value string"), SCHEMA)


def test_blank_sql_is_passthrough(spark):
    df = parsed(spark)
    assert run_sql(df, None, "v") is df
    assert run_sql(df, "   ", "v") is df


def test_select_columns(spark):
    df = parsed(spark)
    assert select_columns(df, ["amt", "nope", "id"]).columns == ["amt", "id"]
    assert select_columns(df, ["nope"]).columns == df.columns
    assert select_columns(df, ["ID"]).columns == df.columns  # case-sensitive
    assert select_columns(df, []).columns == df.columns


def test_sql_sees_the_batch_and_lookups(spark, tmp_path):
    dim = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "cust long, name string")
    path = str(tmp_path / "dim")
    dim.write.parquet(path)
    register_lookup_tables(spark, {"dim_names": path})
    job = JobSpec(name="changes", output=OutputSpec(
        sql="select d.name, count(*) as n, sum(c.amt) as amt from changes c "
            "join dim_names d on c.cust = d.cust where c.op <> 'd' group by d.name",
        columns=["name", "n"]))
    rows = {r.name: r.n for r in apply_batch(parsed(spark), job).collect()}
    assert rows == {"zero": 10, "two": 10}


def test_lazy_batch_is_staged_once_and_persisted_is_not(spark):
    lazy = parsed(spark)
    staged = materialize(lazy)
    assert "parquet" in plan_text(staged).lower() and "parse" not in plan_text(staged).lower()
    cached = lazy.persist()
    try:
        assert materialize(cached) is cached
    finally:
        cached.unpersist()


def test_filter_after_parse_stays_above_it(spark):
    q = parsed(spark).filter(F.col("op") == "c")
    p = plan_text(q, "simple")
    gen, filt = p.index("Generate"), p.index("Filter")
    assert filt < gen  # the Filter sits above the Generate, not below the parse
    assert p.count("parseJson") == 1


def test_keep_column_filter_reaches_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([(i, v) for i, (v,) in enumerate(RECS)], "k long, value string") \
        .write.parquet(path)
    raw = spark.read.parquet(path)
    q = parse_changes(raw, SCHEMA, keep=["k"]).filter(F.col("k") > 10).select("k", "amt")
    p = plan_text(q)
    assert "PushedFilters: [IsNotNull(k), GreaterThan(k,10)]" in p
    assert sorted(r.k for r in q.collect()) == list(range(11, 30))


def test_fused_operation_filter(spark):
    df = spark.createDataFrame(RECS + [("junk",)], "value string")
    ops = parse_changes(df, SCHEMA, operations=["c", "u"]).select("op").collect()
    assert sorted({r.op for r in ops}) == ["c", "u"] and len(ops) == 20
    assert parse_changes(df, SCHEMA, operations=[]).count() == df.count()   # as filter_by_operation([])


def test_parse_plan_is_one_codegen_stage_without_python(spark):
    p = plan_text(parsed(spark))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "Exchange" not in p


def test_unread_fields_are_not_converted(spark):
    schema = [("ts", "timestamp"), ("a", "int"), ("s", "string")]
    df = spark.createDataFrame([('{"after":{"ts":"2024-01-02","a":3,"s":"x"},"op":"c"}',)], "value string")
    p = plan_text(parse_changes(df, schema).groupBy("op").count())
    assert p.lower().count("try_parse_json") + p.count("parseJson") == 1 and "as timestamp" not in p
    few = parse_changes(df, schema, columns=["s"])
    assert few.columns == ["s", "op"] and tuple(few.first()) == ("x", "c")
    assert "a:int" not in plan_text(few).replace(" ", "")


def test_sql_that_reads_once_writes_nothing(spark, monkeypatch):
    from tidemark.plans import batch as b
    written = []
    monkeypatch.setattr(b, "materialize", lambda df: written.append(df.columns) or df)
    frame = parse_changes(spark.createDataFrame(RECS, "value string"), SCHEMA)
    b.run_sql(frame, "select op, count(*) from v group by op", "v", stage=True)
    assert not written
    b.run_sql(frame, "select op from v where id = 1 union all select op from v", "v", stage=True)
    b.run_sql(frame, "with x as (select id, count(*) n from v group by id) select a.n from x a join x b on a.id = b.id", "v",
              stage=True)
    assert len(written) == 2


@pytest.mark.parametrize("sql", ["TABLE v UNION ALL TABLE v", "FROM v |> UNION ALL (FROM v)",
                                 "select * from v where id = 1 union all select * from v"])
def test_staging_keeps_every_column(spark, sql):
    from tidemark.plans import batch as b
    frame = spark.createDataFrame([(1, "a", 0.5), (2, "b", 1.5)], "id long, k string, v double")
    got = b.run_sql(frame, sql, "v", stage=True)
    assert got.columns == ["id", "k", "v"]
    assert set(map(tuple, got.collect())) == {(1, "a", 0.5), (2, "b", 1.5)}
    plain = b.run_sql(frame, sql, "v")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
