"""Registered queries for the change-record operators (parse, casts, metadata,
operation filter, image readers, conform), each with its DuckDB oracle.

Every query builds the change feed of a whole table with Spark, runs the
operator over all of it, and returns typed rows the oracle computes straight
from the table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.changes import after_image, before_image, record_op, source_metadata
from ..operators import conform, filter_by_operation, lift_metadata, parse_after_only, parse_changes
from ..sources.feed import change_feed
from ..spec import field_map
from .common import (
    CUSTOMER_TYPED_SCHEMA, ORDERS_COLS, ORDERS_SCHEMA, as_ntz, customer_feed, customer_rows,
    op_sql, orders_feed, ready, table,
)

OP = op_sql("o_orderkey")
IS_DELETE = f"{OP} = 'd'"
ORDERS_SELECT = ", ".join(ORDERS_COLS)


def _nulls_when(cond: str, cols: list[str]) -> str:
    return ", ".join(f"CASE WHEN {cond} THEN NULL ELSE {c} END AS {c}" for c in cols)


def cdc_parse_orders(spark, sf):
    return as_ntz(parse_changes(orders_feed(spark, sf), ORDERS_SCHEMA))


def cdc_parse_malformed(spark, sf):
    return as_ntz(parse_changes(orders_feed(spark, sf, malformed_every=50), ORDERS_SCHEMA))


def cdc_parse_truncate(spark, sf):
    return as_ntz(parse_changes(orders_feed(spark, sf, truncate_every=10), ORDERS_SCHEMA))


def cdc_parse_missing_op(spark, sf):
    return as_ntz(parse_changes(orders_feed(spark, sf, with_op=False), ORDERS_SCHEMA))


LINEITEM_SCHEMA = [
    {"name": "l_orderkey", "type": "long"}, {"name": "l_partkey", "type": "long"},
    {"name": "l_suppkey", "type": "long"}, {"name": "l_linenumber", "type": "int"},
    {"name": "l_quantity", "type": "double"}, {"name": "l_extendedprice", "type": "double"},
    {"name": "l_discount", "type": "double"}, {"name": "l_tax", "type": "double"},
    {"name": "l_returnflag", "type": "string"}, {"name": "l_linestatus", "type": "string"},
    {"name": "l_shipdate", "type": "timestamp"},
]
LINEITEM_COLS = [f["name"] for f in LINEITEM_SCHEMA]


def cdc_parse_lineitem(spark, sf):
    """The largest table: (order, line number) as the change key."""
    ready(spark)
    li = table(spark, sf, "lineitem")
    keyed = li.withColumn("change_id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    feed = change_feed(keyed, key="change_id", table="lineitem", ts_col="l_shipdate",
                       before_changes={"l_quantity": F.col("l_quantity") + F.lit(1.0)})
    return as_ntz(parse_changes(feed, LINEITEM_SCHEMA))


def cdc_typed_customer(spark, sf):
    return as_ntz(parse_changes(customer_feed(spark, sf), CUSTOMER_TYPED_SCHEMA))


def cdc_cast_failures(spark, sf):
    """Numbers sent as text, text declared as a number, padded numbers."""
    ready(spark)
    c = table(spark, sf, "customer")
    rows = c.select(
        "c_custkey",
        F.col("c_custkey").cast("string").alias("key_text"),
        "c_name",
        F.concat(F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("nation_padded"),
        F.col("c_acctbal").cast("string").alias("balance_text"),
        F.col("c_acctbal").cast("string").alias("balance_as_long"),
        F.col("c_nationkey").alias("nation_as_text"),
        F.col("c_mktsegment").alias("segment_as_bool"),
    )
    feed = change_feed(rows, key="c_custkey", table="customer")
    declared = [
        {"name": "key_text", "type": "long"},
        {"name": "c_name", "type": "int"},
        {"name": "nation_padded", "type": "int"},
        {"name": "balance_text", "type": "double"},
        {"name": "balance_as_long", "type": "bigint"},
        {"name": "nation_as_text", "type": "string"},
        {"name": "segment_as_bool", "type": "boolean"},
    ]
    return parse_changes(feed, declared)


def cdc_struct_text(spark, sf):
    """A nested object declared ``struct`` arrives as JSON text."""
    ready(spark)
    ev = table(spark, sf, "events")
    rows = ev.select("event_id", "ts", "user_id", "event_type", "value",
                     F.parse_json("props").alias("props"))
    feed = change_feed(rows, key="event_id", table="events", db="app", ts_col="ts")
    declared = [{"name": "event_id", "type": "long"}, {"name": "ts", "type": "timestamp"},
                {"name": "user_id", "type": "long"}, {"name": "event_type", "type": "string"},
                {"name": "value", "type": "double"}, {"name": "props", "type": "struct"}]
    parsed = parse_changes(feed, declared)
    return as_ntz(parsed.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("props_k"), "op"))


def cdc_metadata(spark, sf):
    lifted = lift_metadata(orders_feed(spark, sf))
    return lifted.select("key", "op", "ts_ms", "source_table", "source_db")


def cdc_metadata_malformed(spark, sf):
    """Metadata of a feed where every 50th record is not JSON: nulls there."""
    lifted = lift_metadata(orders_feed(spark, sf, malformed_every=50))
    return lifted.select("key", "op", "ts_ms", "source_table", "source_db")


def cdc_parse_before(spark, sf):
    """The parse reading the before image whatever the op."""
    return as_ntz(parse_changes(orders_feed(spark, sf), ORDERS_SCHEMA, keep=["key"], image="before"))


def cdc_filter_upserts(spark, sf):
    return as_ntz(parse_changes(filter_by_operation(orders_feed(spark, sf), ["c", "u"]),
                                ORDERS_SCHEMA, keep=["key"]))


def cdc_parse_upserts(spark, sf):
    """The operation filter decided on the parsed op, before any image is cast."""
    return as_ntz(parse_changes(orders_feed(spark, sf, malformed_every=50), ORDERS_SCHEMA,
                                keep=["key"], operations=["c", "u"]))


def cdc_filter_empty_list(spark, sf):
    feed = filter_by_operation(orders_feed(spark, sf, malformed_every=50), [])
    return as_ntz(parse_changes(feed, ORDERS_SCHEMA, keep=["key"], operations=[]))


NUMBER_TEXT_SCHEMA = [("whole", "string"), ("flag", "boolean"), ("detail", "struct")]


def cdc_number_text(spark, sf):
    """Numbers and objects under text, boolean and struct fields keep their writing."""
    ready(spark)
    part = table(spark, sf, "part").select(
        "p_partkey", F.floor("p_retailprice").cast("double").alias("whole"),
        F.pmod("p_partkey", F.lit(2)).cast("double").alias("flag"),
        F.struct(F.col("p_retailprice").alias("z"), F.col("p_size").alias("a")).alias("detail"))
    feed = change_feed(part, key="p_partkey", table="part")
    return parse_changes(feed, NUMBER_TEXT_SCHEMA, keep=["key"])


def cdc_parse_duplicate_keys(spark, sf):
    """Of equal keys the last one counts, in the record and in its image."""
    ready(spark)
    k = F.col("o_orderkey").cast("string")
    value = F.concat(F.lit('{"op":"d","after":{"k":-1},"after":{"k":0,"s":"first","k":'), k,
                     F.lit(',"s":"last"},"op":"u"}'))
    return parse_changes(table(spark, sf, "orders").select(value.alias("value")), [("k", "long"), ("s", "string")])


def cdc_record_op(spark, sf):
    feed = orders_feed(spark, sf, malformed_every=50)
    return feed.select("key", record_op("value").alias("op"))


_IMAGE_SCHEMA = [{"name": "o_orderkey", "type": "long"}, {"name": "o_totalprice", "type": "double"},
                 {"name": "o_orderstatus", "type": "string"}]


def cdc_before_image(spark, sf):
    feed = orders_feed(spark, sf)
    img = feed.select("key", before_image("value", _IMAGE_SCHEMA).alias("b"))
    return img.select("key", F.col("b.o_orderkey").alias("o_orderkey"),
                      F.col("b.o_totalprice").alias("o_totalprice"),
                      F.col("b.o_orderstatus").alias("o_orderstatus"))


def cdc_after_image(spark, sf):
    feed = orders_feed(spark, sf)
    img = feed.select("key", after_image("value", _IMAGE_SCHEMA).alias("a"),
                      after_image("value").isNull().alias("no_after_text"))
    return img.select("key", F.col("a.o_orderkey").alias("o_orderkey"),
                      F.col("a.o_totalprice").alias("o_totalprice"),
                      F.col("a.o_orderstatus").alias("o_orderstatus"), "no_after_text")


def cdc_source_meta(spark, sf):
    feed = orders_feed(spark, sf)
    m = feed.select("key", source_metadata("value").alias("m"))
    return m.select("key", F.col("m")["db"].alias("source_db"),
                    F.col("m")["table"].alias("source_table"))


def cdc_after_only(spark, sf):
    return as_ntz(parse_after_only(orders_feed(spark, sf), ORDERS_SCHEMA, keep=["key"]))


def conform_declared(spark, sf):
    """``part`` brought to a declared schema: reordered, re-typed, one column absent."""
    ready(spark)
    part = table(spark, sf, "part")
    declared = [
        {"field": "p_partkey", "type": "long"},
        {"field": "p_retailprice", "type": "int"},
        {"field": "p_name", "type": "string"},
        {"field": "p_size", "type": "string"},
        {"field": "p_comment", "type": "string"},
        {"field": "p_brand", "type": "str"},
        {"field": "p_type", "type": "bool"},
    ]
    return conform(part, declared)


def conform_field_map(spark, sf):
    """The same from a name-to-type map: entries without a name are skipped, of two with
    one name the last type counts."""
    ready(spark)
    types = field_map([{"field": "p_partkey", "type": "string"}, {"type": "int"}, {"name": "p_size", "type": "double"},
                       {"field": "p_none"}, {"field": "p_partkey", "type": "long"}])
    return conform(table(spark, sf, "part"), types)


QUERIES = {
    "cdc_parse_orders": cdc_parse_orders,
    "cdc_parse_malformed": cdc_parse_malformed,
    "cdc_parse_truncate": cdc_parse_truncate,
    "cdc_parse_missing_op": cdc_parse_missing_op,
    "cdc_parse_lineitem": cdc_parse_lineitem,
    "cdc_typed_customer": cdc_typed_customer,
    "cdc_cast_failures": cdc_cast_failures,
    "cdc_struct_text": cdc_struct_text,
    "cdc_metadata": cdc_metadata,
    "cdc_metadata_malformed": cdc_metadata_malformed,
    "cdc_parse_before": cdc_parse_before,
    "cdc_filter_upserts": cdc_filter_upserts,
    "cdc_parse_upserts": cdc_parse_upserts,
    "cdc_filter_empty_list": cdc_filter_empty_list,
    "cdc_number_text": cdc_number_text,
    "cdc_parse_duplicate_keys": cdc_parse_duplicate_keys,
    "cdc_record_op": cdc_record_op,
    "cdc_before_image": cdc_before_image,
    "cdc_after_image": cdc_after_image,
    "cdc_source_meta": cdc_source_meta,
    "cdc_after_only": cdc_after_only,
    "conform_declared": conform_declared,
    "conform_field_map": conform_field_map,
}

_CK = "c_custkey"

ORACLES = {
    "conform_field_map": "SELECT p_partkey, p_size::DOUBLE AS p_size, NULL::VARCHAR AS p_none FROM part",
    "cdc_parse_orders": f"SELECT {ORDERS_SELECT}, {OP} AS op FROM orders",
    "cdc_parse_malformed": (
        f"SELECT {_nulls_when('o_orderkey % 50 = 0', ORDERS_COLS)}, "
        f"CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {OP} END AS op FROM orders"),
    "cdc_parse_truncate": (
        f"SELECT {_nulls_when('o_orderkey % 10 = 0', ORDERS_COLS)}, "
        f"CASE WHEN o_orderkey % 10 = 0 THEN 't' ELSE {OP} END AS op FROM orders"),
    "cdc_parse_missing_op": (
        f"SELECT {_nulls_when(IS_DELETE, ORDERS_COLS)}, '' AS op FROM orders"),
    "cdc_parse_lineitem": (
        f"SELECT {', '.join(LINEITEM_COLS)}, {op_sql('(l_orderkey * 8 + l_linenumber)')} AS op "
        "FROM lineitem"),
    "cdc_typed_customer": (
        "SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS FLOAT) AS c_acctbal, c_mktsegment, "
        "c_custkey % 3 = 0 AS c_active, "
        "CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS c_since, "
        "TIMESTAMP '2020-01-01 00:00:00' + to_seconds(c_custkey * 37) AS c_seen, "
        "'{\"n\":' || c_nationkey || ',\"seg\":\"' || c_mktsegment || '\"}' AS c_profile, "
        "CASE c_custkey % 5 WHEN 0 THEN '+84 9' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') "
        "WHEN 1 THEN '0084-9' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') "
        "WHEN 2 THEN '(09) ' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') "
        "WHEN 3 THEN '84' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') ELSE 'n/a' END AS c_phone, "
        f"{op_sql(_CK)} AS op FROM customer"),
    "cdc_cast_failures": (
        "SELECT c_custkey AS key_text, CAST(NULL AS INTEGER) AS c_name, c_nationkey AS nation_padded, "
        "c_acctbal AS balance_text, CAST(NULL AS BIGINT) AS balance_as_long, "
        "CAST(c_nationkey AS VARCHAR) AS nation_as_text, "
        "lower(c_mktsegment) IN ('true', '1', 'yes') AS segment_as_bool, "
        f"{op_sql(_CK)} AS op FROM customer"),
    "cdc_struct_text": (
        "SELECT event_id, ts, user_id, event_type, value, "
        "CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k, "
        f"{op_sql('event_id')} AS op FROM events"),
    "cdc_metadata": (
        f"SELECT CAST(o_orderkey AS VARCHAR) AS key, {OP} AS op, epoch_ms(o_orderdate) AS ts_ms, "
        "'orders' AS source_table, 'tpch' AS source_db FROM orders"),
    "cdc_metadata_malformed": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS key, "
        f"CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {OP} END AS op, "
        "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE epoch_ms(o_orderdate) END AS ts_ms, "
        "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE 'orders' END AS source_table, "
        "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE 'tpch' END AS source_db FROM orders"),
    "cdc_parse_before": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS key, "
        f"CASE WHEN {OP} IN ('u', 'd') THEN o_orderkey END AS o_orderkey, "
        f"CASE WHEN {OP} IN ('u', 'd') THEN o_custkey END AS o_custkey, "
        f"CASE {OP} WHEN 'u' THEN 'O' WHEN 'd' THEN o_orderstatus END AS o_orderstatus, "
        f"CASE {OP} WHEN 'u' THEN o_totalprice - 1.0 WHEN 'd' THEN o_totalprice END AS o_totalprice, "
        f"CASE WHEN {OP} IN ('u', 'd') THEN o_orderdate END AS o_orderdate, "
        f"CASE WHEN {OP} IN ('u', 'd') THEN o_orderpriority END AS o_orderpriority, "
        f"{OP} AS op FROM orders"),
    "cdc_filter_upserts": (
        f"SELECT CAST(o_orderkey AS VARCHAR) AS key, {ORDERS_SELECT}, {OP} AS op "
        f"FROM orders WHERE {OP} IN ('c', 'u')"),
    "cdc_parse_upserts": (
        f"SELECT CAST(o_orderkey AS VARCHAR) AS key, {ORDERS_SELECT}, {OP} AS op "
        f"FROM orders WHERE {OP} IN ('c', 'u') AND o_orderkey % 50 <> 0"),
    "cdc_filter_empty_list": (
        f"SELECT CAST(o_orderkey AS VARCHAR) AS key, {_nulls_when('o_orderkey % 50 = 0', ORDERS_COLS)}, "
        f"CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {OP} END AS op FROM orders"),
    "cdc_number_text": (
        "SELECT CAST(p_partkey AS VARCHAR) AS key, CAST(CAST(floor(p_retailprice) AS DOUBLE) AS VARCHAR) AS whole, "
        "false AS flag, '{\"z\":' || CAST(p_retailprice AS VARCHAR) || ',\"a\":' || CAST(p_size AS VARCHAR) || '}' "
        f"AS detail, {op_sql('p_partkey')} AS op FROM part"),
    "cdc_parse_duplicate_keys": "SELECT o_orderkey AS k, 'last' AS s, 'u' AS op FROM orders",
    "cdc_record_op": (
        f"SELECT CAST(o_orderkey AS VARCHAR) AS key, "
        f"CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {OP} END AS op FROM orders"),
    "cdc_before_image": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS key, "
        f"CASE WHEN {OP} IN ('u', 'd') THEN o_orderkey END AS o_orderkey, "
        f"CASE {OP} WHEN 'u' THEN o_totalprice - 1.0 WHEN 'd' THEN o_totalprice END AS o_totalprice, "
        f"CASE {OP} WHEN 'u' THEN 'O' WHEN 'd' THEN o_orderstatus END AS o_orderstatus "
        "FROM orders"),
    "cdc_after_image": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS key, "
        f"CASE WHEN {OP} <> 'd' THEN o_orderkey END AS o_orderkey, "
        f"CASE WHEN {OP} <> 'd' THEN o_totalprice END AS o_totalprice, "
        f"CASE WHEN {OP} <> 'd' THEN o_orderstatus END AS o_orderstatus, "
        f"{OP} = 'd' AS no_after_text FROM orders"),
    "cdc_source_meta": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS key, 'tpch' AS source_db, 'orders' AS source_table "
        "FROM orders"),
    "cdc_after_only": (
        f"SELECT CAST(o_orderkey AS VARCHAR) AS key, {ORDERS_SELECT} FROM orders "
        f"WHERE {OP} <> 'd'"),
    "conform_declared": (
        "SELECT p_partkey, CAST(trunc(p_retailprice) AS INTEGER) AS p_retailprice, p_name, "
        "CAST(p_size AS VARCHAR) AS p_size, CAST(NULL AS VARCHAR) AS p_comment, p_brand, "
        "lower(p_type) IN ('true', '1', 'yes') AS p_type FROM part"),
}
