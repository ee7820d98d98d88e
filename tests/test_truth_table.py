"""Row outcomes of the change-record parse, as literal input/expected pairs."""

import pytest
from pyspark.sql import functions as F

from tidemark import parse_changes
from tidemark.operators import parse_after_only

SCHEMA = [{"name": "a", "type": "int"}, {"name": "s", "type": "string"}]

CASES = [
    ('{"after":{"a":1,"s":"x"},"op":"u"}', (1, "x", "u")),
    ('{"before":{"a":1,"s":"x"},"after":null,"op":"d"}', (1, "x", "d")),
    ('{"after":null,"op":"t"}', (None, None, "t")),
    ('{"after":{"a":1,"s":"x"}}', (1, "x", "")),
    ('{"after":{"a":1,"s":"x"},"op":null}', (None, None, None)),
    ('{"after":{"a":1,"s":"x"},"op":5}', (None, None, None)),
    ('{"after":"text","op":"c"}', (None, None, None)),
    ('[1]', (None, None, None)),
    ('not json', (None, None, None)),
    (None, (None, None, None)),
    ('{"payload":{"after":{"a":1},"op":"c"}}', (None, None, "")),
    ('{"after":{"a":"12"},"op":"c"}', (12, None, "c")),
    ('{"after":{"a":12.7},"op":"c"}', (12, None, "c")),
    ('{"after":{"a":"12.7"},"op":"c"}', (None, None, "c")),
    ('{"after":{"a":true},"op":"c"}', (1, None, "c")),
    ('{"after":{"a":"abc","s":7},"op":"c"}', (None, "7", "c")),
    # duplicate keys: the last one wins
    ('{"after":{"a":1,"a":2,"s":"x"},"op":"c"}', (2, "x", "c")),
    ('{"after":{"a":" 7 "},"op":"c"}', (7, None, "c")),
    ('{"before":{"a":3},"after":{"a":4},"op":"d"}', (3, None, "d")),
    ('{"before":{"a":3},"after":{"a":4},"op":"r"}', (4, None, "r")),
    ('{"after":{"a":1,"s":{"k":[1,2]}},"op":"c"}', (1, '{"k":[1,2]}', "c")),
    ('{"after":{"a":1,"s":true},"op":"c"}', (1, "true", "c")),
    ('{"after":[1,2],"op":"c"}', (None, None, None)),
    ('{"before":"x","after":{"a":1},"op":"d"}', (None, None, None)),
]


def test_truth_table(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "id int, value string")
    out = parse_changes(df, SCHEMA, keep=["id"])
    assert out.columns == ["id", "a", "s", "op"]
    got = {r.id: (r.a, r.s, r.op) for r in out.collect()}
    for i, (v, want) in enumerate(CASES):
        assert got[i] == want, (v, got[i], want)


def test_image_by_operation(spark):
    schema = [("o_orderkey", "long"), ("o_orderstatus", "string")]
    recs = ['{"op":"c","before":null,"after":{"o_orderkey":31,"o_orderstatus":"O"}}',
            '{"op":"d","before":{"o_orderkey":32,"o_orderstatus":"F"},"after":null}']
    df = spark.createDataFrame([(r,) for r in recs], "value string")
    assert [tuple(r) for r in parse_changes(df, schema).collect()] == [(31, "O", "c"), (32, "F", "d")]


TEXTS = [
    ('{"after":{"s":73.0},"op":"c"}', "73.0", False),
    ('{"after":{"s":12345678901234567890123456789012345678901},"op":"c"}', "1" + "2345678901" * 4, False),
    ('{"after":{"s":1.0},"op":"c"}', "1.0", False),
    ('{"after":{"s":1},"op":"c"}', "1", True),
    ('{"after":{"s": {"z":1.0,"a":2}},"op":"c"}', '{"z":1.0,"a":2}', False),
    ('{"before":{"s":2.50},"after":{"s":"no"},"op":"d"}', "2.5", False),
    ('{"after":{"s":true},"op":"c"}', "true", True),
    ('{"after":{"\\u0073":4.0},"op":"c"}', "4.0", False),
]


def test_text_fields_keep_the_writing(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(TEXTS)], "i int, value string")
    as_text = {r.i: r.s for r in parse_changes(df, [("s", "string")], keep=["i"]).collect()}
    as_bool = {r.i: r.s for r in parse_changes(df, [("s", "boolean")], keep=["i"]).collect()}
    as_struct = {r.i: r.s for r in parse_changes(df, [("s", "struct")], keep=["i"]).collect()}
    for i, (v, text, flag) in enumerate(TEXTS):
        assert (as_text[i], as_struct[i], as_bool[i]) == (text, text, flag), v


def test_equal_keys_need_no_setting(spark):
    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    df = spark.createDataFrame([('{"after":{"a":1,"a":2},"op":"c"}',)], "value string")
    assert parse_changes(df, [("a", "int")]).first().a == 2


def test_binary_value(spark):
    df = spark.createDataFrame([(bytearray(b'{"after":{"a":5},"op":"c"}'),)], "value binary")
    assert [tuple(r) for r in parse_changes(df, SCHEMA).collect()] == [(5, None, "c")]


def test_output_schema_is_declared_plus_op(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    out = parse_changes(df, [{"name": "x", "type": "LONG "}, {"name": "y", "type": "weird"}])
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [
        ("x", "bigint"), ("y", "string"), ("op", "string")]


def test_op_field_rejected(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    with pytest.raises(ValueError):
        parse_changes(df, [{"name": "op", "type": "string"}])


def test_after_only(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "id int, value string")
    got = {r.id: (r.a, r.s) for r in parse_after_only(df, SCHEMA, keep=["id"]).collect()}
    # kept: records whose after is an object, whatever the op
    assert got[0] == (1, "x") and got[3] == (1, "x") and got[4] == (1, "x") and got[5] == (1, "x")
    assert 1 not in got and 2 not in got and 6 not in got and 7 not in got and 8 not in got
    assert 10 not in got
    assert got[18] == (4, None)


def test_odd_field_and_column_names(spark):
    df = spark.createDataFrame(
        [("k1", '{"after":{"a.b":1,"with space":"x","it`s":true},"op":"c"}')],
        "`kafka.key` string, `the value` string")
    schema = [("a.b", "int"), ("with space", "string"), ("it`s", "boolean")]
    out = parse_changes(df, schema, value_col="the value", keep=["kafka.key"])
    assert out.columns == ["kafka.key", "a.b", "with space", "it`s", "op"]
    assert tuple(out.first()) == ("k1", 1, "x", True, "c")


def test_keys_are_case_sensitive(spark):
    df = spark.createDataFrame([('{"after":{"A":1,"a":2},"op":"c"}',), ('{"after":{"A":1},"op":"c"}',)],
                               "value string")
    assert [r.a for r in parse_changes(df, [("a", "int")]).collect()] == [2, None]


def test_kept_columns_may_not_clash(spark):
    df = spark.createDataFrame([("k", "{}")], "op string, value string")
    with pytest.raises(ValueError):
        parse_changes(df, SCHEMA, keep=["op"])


def test_long_texts_are_read(spark):
    sizes = [10, 25_000_000]
    for n in sizes:
        df = spark.range(1).select(F.concat(
            F.lit('{"after":{"a":1,"a":2,"s":"'), F.repeat(F.lit("x"), n), F.lit('"},"op":"c"}')).alias("value"))
        row = parse_changes(df, SCHEMA).select("a", F.length("s"), "op").first()
        assert tuple(row) == (2, n, "c")
