"""Metadata lift, operation filter and the column functions on raw records."""

from pyspark.sql import functions as F

from helpers import plan_text
from tidemark import (after_image, before_image, filter_by_operation, lift_metadata, record_op,
                      source_metadata)

RECS = [
    (1, '{"before":null,"after":{"a":1},"source":{"db":"d1","table":"t1"},"op":"c","ts_ms":1700000000000}'),
    (2, '{"before":{"a":2},"after":null,"source":{"db":"d1","table":"t1"},"op":"d","ts_ms":"7"}'),
    (3, '{"after":{"a":3},"source":"not an object","op":"u"}'),
    (4, 'not json'),
    (5, '[1,2]'),
    (6, '{"after":{"a":6},"op":null}'),
    (7, None),
]


def frame(spark):
    return spark.createDataFrame(RECS, "id int, value string")


def test_lift_metadata(spark):
    out = lift_metadata(frame(spark))
    assert out.columns == ["id", "value", "op", "ts_ms", "source_table", "source_db"]
    assert out.schema["ts_ms"].dataType.simpleString() == "bigint"
    got = {r.id: (r.op, r.ts_ms, r.source_table, r.source_db) for r in out.collect()}
    assert got[1] == ("c", 1700000000000, "t1", "d1")
    assert got[2] == ("d", 7, "t1", "d1")
    assert got[3] == ("u", None, None, None)
    for i in (4, 5, 7):
        assert got[i] == (None, None, None, None)
    assert got[6] == (None, None, None, None)


def test_filter_by_operation(spark):
    df = frame(spark)
    assert filter_by_operation(df, []) is df
    assert filter_by_operation(df, None) is df
    kept = filter_by_operation(df, ["c", "d"])
    assert kept.columns == df.columns
    assert sorted(r.id for r in kept.collect()) == [1, 2]


def test_record_op_and_images(spark):
    out = frame(spark).select(
        "id", record_op("value").alias("op"),
        before_image("value").alias("b"), after_image("value").alias("a"),
        after_image("value", [("a", "long")]).alias("typed"),
        source_metadata("value").alias("src"))
    got = {r.id: r for r in out.collect()}
    assert got[1].op == "c" and got[1].b is None and got[1].a == '{"a":1}'
    assert got[1].typed.a == 1 and got[1].src == {"db": "d1", "table": "t1"}
    assert got[2].b == '{"a":2}' and got[2].a is None and got[2].typed is None
    assert got[3].src is None
    assert all(got[i].op is None and got[i].a is None for i in (4, 5, 7))


def test_no_python_in_plans(spark):
    df = frame(spark)
    for q in (lift_metadata(df), filter_by_operation(df, ["c"]),
              df.select(record_op("value"), after_image("value", [("a", "int")]))):
        p = plan_text(q)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
        assert "[codegen id" in p


def test_typed_image_with_post_processed_fields(spark):
    import datetime as dt
    df = spark.createDataFrame([
        ('{"before":{"flag":"YES","at":"2024-05-06T07:08:09","n":"3"},"op":"d"}',),
        ('{"before":"text","op":"d"}',),
        ('{"op":"c"}',)], "value string")
    schema = [("flag", "boolean"), ("at", "timestamp"), ("n", "int")]
    rows = df.select(before_image("value", schema).alias("b")).select("b.*").collect()
    assert tuple(rows[0]) == (True, dt.datetime(2024, 5, 6, 7, 8, 9), 3)
    assert tuple(rows[1]) == (None, None, None) and tuple(rows[2]) == (None, None, None)
    p = plan_text(df.select(before_image("value", schema).alias("b")).select("b.*"))
    assert "BatchEvalPython" not in p


def test_lift_metadata_replaces_existing_columns_in_place(spark):
    df = spark.createDataFrame([("old", '{"op":"u","ts_ms":5,"source":{"db":"d","table":"t"}}')],
                               "op string, value string")
    out = lift_metadata(df)
    assert out.columns == ["op", "value", "ts_ms", "source_table", "source_db"]
    assert tuple(out.first()) == ("u", '{"op":"u","ts_ms":5,"source":{"db":"d","table":"t"}}', 5, "t", "d")
