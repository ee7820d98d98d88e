"""Shared pieces of the registered queries: tables, change feeds, declared
schemas and the SQL form of the feed rule (for the DuckDB oracles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..session import prepare_session
from ..sources.feed import change_feed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    prepare_session(spark)


def as_ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns -> TIMESTAMP_NTZ, like the source tables (wall-clock kept)."""
    return df.select(*[F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def op_sql(key: str) -> str:
    """The feed's op rule in SQL."""
    return (f"CASE {key} % 4 WHEN 0 THEN 'c' WHEN 1 THEN 'u' WHEN 2 THEN 'd' ELSE 'r' END")


ORDERS_SCHEMA = [
    {"name": "o_orderkey", "type": "long"},
    {"name": "o_custkey", "type": "bigint"},
    {"name": "o_orderstatus", "type": "string"},
    {"name": "o_totalprice", "type": "double"},
    {"name": "o_orderdate", "type": "timestamp"},
    {"name": "o_orderpriority", "type": "str"},
]
ORDERS_COLS = [f["name"] for f in ORDERS_SCHEMA]
ORDERS_VIEW = "orders_changes"


def orders_feed(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Change records of ``orders``; an update's before image has a lower price
    and status ``O``, so reading the wrong image shows."""
    ready(spark)
    o = table(spark, sf_dir, "orders")
    return change_feed(o, key="o_orderkey", table="orders", ts_col="o_orderdate",
                       before_changes={"o_totalprice": F.col("o_totalprice") - F.lit(1.0),
                                       "o_orderstatus": F.lit("O")}, **kw)


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` plus columns of every declared type, derived from its rows."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        (F.pmod(k, F.lit(3)) == 0).alias("c_active"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(k, F.lit(1000)).cast("int")).alias("c_since"),
        F.timestamp_add("SECOND", k * 37, F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")).alias("c_seen"),
        F.struct(F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("seg")).alias("c_profile"),
        phone_text(k).alias("c_phone"),
    )


def phone_text(k):
    """Phone numbers in five written forms, made from the key."""
    body = F.lpad(k.cast("string"), 8, "0")
    m = F.pmod(k, F.lit(5))
    return (F.when(m == 0, F.concat(F.lit("+84 9"), body))
             .when(m == 1, F.concat(F.lit("0084-9"), body))
             .when(m == 2, F.concat(F.lit("(09) "), body))
             .when(m == 3, F.concat(F.lit("84"), F.lpad(k.cast("string"), 4, "0")))
             .otherwise(F.lit("n/a")))


CUSTOMER_TYPED_SCHEMA = [
    {"name": "c_custkey", "type": "bigint"},
    {"name": "c_name", "type": "str"},
    {"name": "c_nationkey", "type": "integer"},
    {"name": "c_acctbal", "type": "float"},
    {"name": "c_mktsegment", "type": "string"},
    {"name": "c_active", "type": "bool"},
    {"name": "c_since", "type": "date"},
    {"name": "c_seen", "type": "timestamp"},
    {"name": "c_profile", "type": "struct"},
    {"name": "c_phone", "type": "varchar"},
]


def customer_feed(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    ready(spark)
    return change_feed(customer_rows(spark, sf_dir), key="c_custkey", table="customer", **kw)
