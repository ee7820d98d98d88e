"""Declared types, cast rules on typed columns, conform, job spec, SQL functions."""

import datetime as dt

import pytest

from tidemark import DeclaredSchema, JobSpec, conform, safe_cast
from tidemark.functions.phone import phone_function_sql, register_functions
from tidemark.spec import TYPE_NAMES, field_map, spark_type_name


def test_type_names():
    assert spark_type_name(" INTEGER ") == "int"
    assert spark_type_name("bigint") == spark_type_name("long") == "bigint"
    assert spark_type_name("struct") == "string"
    assert spark_type_name("decimal(10,2)") == "string"
    assert spark_type_name(None) == "string"
    assert set(TYPE_NAMES) >= {"str", "bool", "float", "date", "timestamp"}


def test_declared_schema_forms():
    a = DeclaredSchema.coerce([{"name": "x", "type": "int"}, {"field": "y"}])
    b = DeclaredSchema.coerce({"fields": [{"name": "x", "type": "int"}, {"name": "y", "type": "string"}]})
    c = DeclaredSchema.coerce([("x", "int"), ("y", "string")])
    assert a.names == b.names == c.names == ["x", "y"]
    assert a.struct_type(with_op=True).simpleString() == "struct<x:int,y:string,op:string>"
    with pytest.raises(ValueError):
        DeclaredSchema.coerce([{"type": "int"}])


def test_field_map_skips_unnamed_and_last_wins():
    assert field_map([{"field": "a", "type": "int"}, {"type": "x"}, {"field": "a", "type": "long"}]) == {"a": "long"}


def test_job_spec_from_dict():
    spec = JobSpec.from_dict({
        "job": {"name": "j1"},
        "schema": [{"name": "a", "type": "int"}],
        "source": {"kind": "files", "path": "/x", "password": "secret"},
        "output": {"sql": "select * from j1", "columns": ["a"]},
        "spark": {"trigger_interval": "5 seconds"},
    })
    assert spec.name == "j1" and spec.view_name == "j1"
    assert spec.spark.trigger_interval == "5 seconds" and spec.spark.shuffle_partitions is None
    assert "secret" not in repr(spec.source)
    with pytest.raises(ValueError):
        JobSpec.from_dict({"output": {"no_such_key": 1}})


def test_safe_cast_rules(spark):
    df = spark.createDataFrame(
        [(1, "12", 12.7, " 7 ", True, "yes", "2024-01-02", "2024-01-02T03:04:05", "12.7", "abc")],
        "i int, s12 string, d double, padded string, b boolean, yes string, ds string, ts string, s127 string, abc string")
    r = df.select(
        safe_cast("s12", "int").alias("a"), safe_cast("d", "long").alias("b"),
        safe_cast("padded", "int").alias("c"), safe_cast("b", "int").alias("d"),
        safe_cast("yes", "bool").alias("e"), safe_cast("i", "boolean").alias("f"),
        safe_cast("ds", "date").alias("g"), safe_cast("ts", "timestamp").alias("h"),
        safe_cast("s127", "int").alias("i"), safe_cast("abc", "double").alias("j"),
        safe_cast("d", "string").alias("k"), safe_cast("abc", "boolean").alias("l"),
    ).first()
    assert (r.a, r.b, r.c, r.d) == (12, 12, 7, 1)
    assert r.e is True and r.f is True and r.l is False
    assert r.g == dt.date(2024, 1, 2) and r.h == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r.i is None and r.j is None and r.k == "12.7"


def test_conform_orders_fills_and_casts(spark):
    df = spark.createDataFrame([(1, "x", 2.9)], "id long, name string, price double")
    out = conform(df, [{"name": "price", "type": "int"}, {"name": "missing", "type": "date"},
                       {"name": "id", "type": "string"}])
    assert out.columns == ["price", "missing", "id"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["int", "date", "string"]
    assert tuple(out.first()) == (2, None, "1")


def test_phone_function(spark):
    register_functions(spark)
    rows = spark.sql(
        "select transform_phone_number(p) as n from values "
        "('+84 912 345 678'), ('0084-912345678'), ('(09) 1234 5678'), ('8412'), ('n/a'), (null) as t(p)"
    ).collect()
    assert [r.n for r in rows] == ["0912345678", "0912345678", "0912345678", "8412", None, None]


def test_phone_function_country_code():
    sql = phone_function_sql("1")
    assert "^001[0-9]{9,}$" in sql and "^1[0-9]{9,}$" in sql
    with pytest.raises(ValueError):
        phone_function_sql("+1")


def test_job_functions(spark):
    register_functions(spark, {"twice": "(x INT) RETURNS INT RETURN x * 2"})
    assert spark.sql("select twice(21) as v").first().v == 42
    with pytest.raises(ValueError):
        register_functions(spark, {"bad name": "(x INT) RETURNS INT RETURN x"})
