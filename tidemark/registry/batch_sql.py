"""Registered queries for the per-batch SQL transform, column selection and
SQL functions.  The parsed ``orders`` change feed is one bounded batch,
registered under the job's view name; ``dim_customer`` and ``dim_nation`` are
the job's lookup tables.

The oracle runs the *same SQL text* in DuckDB, with the view and lookup names
bound by a CTE to rows computed from the original tables.
"""

from __future__ import annotations

from ..functions.phone import register_functions
from ..operators import parse_changes
from ..plans.batch import apply_batch
from ..spec import JobSpec, OutputSpec
from ..streaming.runner import register_lookup_tables
from ..sources.feed import change_feed
from .cdc import cdc_parse_lineitem
from .common import (
    CUSTOMER_TYPED_SCHEMA, ORDERS_COLS, ORDERS_SCHEMA, ORDERS_VIEW, as_ntz, customer_feed, op_sql,
    orders_feed, ready, table,
)

CUSTOMERS_VIEW = "customers_changes"

_ORACLE_VIEWS = (
    f"WITH {ORDERS_VIEW} AS (SELECT {', '.join(ORDERS_COLS)}, {op_sql('o_orderkey')} AS op FROM orders), "
    "dim_customer AS (SELECT * FROM customer), dim_nation AS (SELECT * FROM nation) "
)

SQL = {
    # the batch read twice, no column named
    "sql_table_twice": f"TABLE {ORDERS_VIEW} UNION ALL TABLE {ORDERS_VIEW}",
    "sql_pipe_twice": f"FROM {ORDERS_VIEW} |> UNION ALL (FROM {ORDERS_VIEW})",
    "sql_identity": f"select * from {ORDERS_VIEW} where 1=1",
    "sql_filter_project": (
        f"select o_orderkey, o_custkey, o_totalprice, o_orderdate, op from {ORDERS_VIEW} "
        "where op in ('c', 'u', 'r') and o_totalprice > 100000"),
    "sql_join_inner": (
        f"select b.o_orderkey, b.op, c.c_name, c.c_mktsegment from {ORDERS_VIEW} b "
        "join dim_customer c on b.o_custkey = c.c_custkey"),
    "sql_join_left": (
        f"select b.o_orderkey, b.op, c.c_name from {ORDERS_VIEW} b "
        "left join dim_customer c on b.o_custkey = c.c_custkey and c.c_mktsegment = 'BUILDING'"),
    "sql_join_semi": (
        f"select b.o_orderkey, b.op from {ORDERS_VIEW} b where exists "
        "(select 1 from dim_customer c where c.c_custkey = b.o_custkey and c.c_acctbal > 5000)"),
    "sql_join_anti": (
        f"select b.o_orderkey, b.op from {ORDERS_VIEW} b where not exists "
        "(select 1 from dim_customer c where c.c_custkey = b.o_custkey and c.c_acctbal > 5000)"),
    # nation has a fixed 25 rows at every scale: a proven bound, so the hint is safe
    "sql_join_range": (
        f"select /*+ BROADCAST(n) */ b.o_orderkey, n.n_name from {ORDERS_VIEW} b "
        "join dim_nation n on n.n_nationkey between b.o_custkey % 25 - 1 and b.o_custkey % 25 + 1"),
    "sql_aggregate": (
        "select op, o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total, "
        "count(distinct o_custkey) as customers, max(o_orderdate) as last_order "
        f"from {ORDERS_VIEW} group by op, o_orderstatus having count(*) > 10"),
    "sql_rollup": (
        "select op, o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total "
        f"from {ORDERS_VIEW} group by rollup (op, o_orderpriority)"),
    "sql_cube": (
        "select op, o_orderstatus, count(*) as n, max(o_orderkey) as last_key "
        f"from {ORDERS_VIEW} group by cube (op, o_orderstatus)"),
    "sql_grouping_sets": (
        "select op, o_orderpriority, o_orderstatus, count(*) as n, min(o_custkey) as first_customer "
        f"from {ORDERS_VIEW} group by grouping sets ((op, o_orderpriority), (o_orderstatus), ())"),
    "sql_distinct": f"select distinct o_custkey, op from {ORDERS_VIEW}",
    "sql_topk": (
        f"select o_orderkey, o_totalprice, op from {ORDERS_VIEW} "
        "order by o_totalprice desc, o_orderkey limit 10"),
    "sql_setops": (
        f"(select o_custkey from {ORDERS_VIEW} where op = 'c' "
        f"intersect select o_custkey from {ORDERS_VIEW} where op = 'u') "
        f"union (select o_custkey from {ORDERS_VIEW} where op = 'd' "
        f"except select o_custkey from {ORDERS_VIEW} where op = 'r')"),
    "sql_subquery_cte": (
        f"with spend as (select o_custkey, sum(o_totalprice) as s from {ORDERS_VIEW} group by o_custkey) "
        "select o_custkey, round(s, 2) as spend from spend "
        "where s > (select avg(s) from spend)"),
    "sql_custom_function": (
        f"select o_orderkey, net_price(o_totalprice, 0.25) as net from {ORDERS_VIEW} where op <> 'd'"),
}

# The job's own SQL function (registered before the SQL runs).
JOB_FUNCTIONS = {"net_price": "(p DOUBLE, d DOUBLE) RETURNS DOUBLE RETURN p * (1 - d)"}

# Latest change per customer: max_by is an aggregate with a map-side partial
# step, so a customer holding a third of the batch is reduced before the
# shuffle (a row_number window would put all of its rows in one task).
LATEST_SQL = (
    "select o_custkey, l.k as latest_orderkey, l.op as latest_op, l.p as latest_price "
    "from (select o_custkey, max_by(named_struct('k', o_orderkey, 'op', op, 'p', o_totalprice), "
    f"struct(o_orderdate, o_orderkey)) as l from {ORDERS_VIEW} group by o_custkey)")

LATEST_ORACLE = (
    _ORACLE_VIEWS +
    "select o_custkey, o_orderkey as latest_orderkey, op as latest_op, o_totalprice as latest_price "
    "from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, "
    f"o_orderkey desc) as rn from {ORDERS_VIEW}) where rn = 1")

PHONE_SQL = (f"select c_custkey, c_phone, transform_phone_number(c_phone) as phone "
             f"from {CUSTOMERS_VIEW}")

_DIGITS = "regexp_replace(c_phone, '[^0-9]', '', 'g')"
PHONE_ORACLE = (
    "with p as (select c_custkey, CASE c_custkey % 5 "
    "WHEN 0 THEN '+84 9' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') "
    "WHEN 1 THEN '0084-9' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') "
    "WHEN 2 THEN '(09) ' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') "
    "WHEN 3 THEN '84' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') ELSE 'n/a' END AS c_phone "
    "from customer), d as (select c_custkey, c_phone, " + _DIGITS + " AS digits from p) "
    "select c_custkey, c_phone, CASE WHEN digits = '' THEN NULL "
    "WHEN regexp_full_match(digits, '0084[0-9]{9,}') THEN '0' || substr(digits, 5) "
    "WHEN regexp_full_match(digits, '84[0-9]{9,}') THEN '0' || substr(digits, 3) "
    "ELSE digits END AS phone from d")


def _orders_batch(spark, sf):
    ready(spark)
    register_functions(spark, JOB_FUNCTIONS)
    base = sf.rstrip("/")
    register_lookup_tables(spark, {"dim_customer": f"{base}/customer.parquet",
                                   "dim_nation": f"{base}/nation.parquet"})
    return parse_changes(orders_feed(spark, sf), ORDERS_SCHEMA)


def _sql_query(sql: str, columns=None):
    def run(spark, sf):
        job = JobSpec(name=ORDERS_VIEW, output=OutputSpec(sql=sql, columns=columns))
        return as_ntz(apply_batch(_orders_batch(spark, sf), job))
    return run


LINEITEM_VIEW = "lineitem_changes"
PRICING_SQL = (
    "select op, l_returnflag, l_linestatus, count(*) as n, sum(l_quantity) as sum_qty, "
    "round(sum(l_extendedprice), 2) as sum_base_price, min(l_discount) as min_disc, "
    "max(l_discount) as max_disc, count(distinct l_orderkey) as orders "
    f"from {LINEITEM_VIEW} where l_shipdate < timestamp '2000-01-01 00:00:00' "
    "group by op, l_returnflag, l_linestatus")


def sql_pricing_summary(spark, sf):
    """A pricing summary over the lineitem change batch (filter, group, distinct)."""
    batch = cdc_parse_lineitem(spark, sf)
    return apply_batch(batch, JobSpec(name=LINEITEM_VIEW, output=OutputSpec(sql=PRICING_SQL)))


# An order has few lines (17 at most at sf0.1), so no window holds many rows; the
# order is total over every column that the result depends on.
_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice"
WINDOW_SQL = {
    "sql_window_rank": (
        "select l_orderkey, l_partkey, l_quantity, "
        f"row_number() over (partition by l_orderkey order by {_LINE_ORDER}) as line_rank, "
        "dense_rank() over (partition by l_orderkey order by l_quantity desc) as quantity_rank "
        f"from {LINEITEM_VIEW} where op <> 'd'"),
    "sql_window_frame": (
        "select l_orderkey, l_partkey, l_quantity, "
        f"sum(l_quantity) over (partition by l_orderkey order by {_LINE_ORDER} "
        "rows between 2 preceding and current row) as recent_quantity, "
        f"lag(l_quantity, 1, 0.0) over (partition by l_orderkey order by {_LINE_ORDER}) as prior_quantity "
        f"from {LINEITEM_VIEW}"),
}


def _lineitem_query(sql: str):
    def run(spark, sf):
        batch = cdc_parse_lineitem(spark, sf)
        return apply_batch(batch, JobSpec(name=LINEITEM_VIEW, output=OutputSpec(sql=sql)))
    return run


EVENTS_VIEW = "events_changes"
EVENTS_SCHEMA = [("event_id", "long"), ("ts", "timestamp"), ("user_id", "long"),
                 ("event_type", "string"), ("value", "double")]
HOURLY_SQL = (
    "select date_trunc('HOUR', ts) as hour, event_type, count(*) as n, "
    "count(distinct user_id) as users, round(sum(value), 2) as total "
    f"from {EVENTS_VIEW} where op <> 'd' group by 1, 2")


def sql_hourly_events(spark, sf):
    """Hourly activity per event type over the events change batch."""
    ready(spark)
    ev = table(spark, sf, "events")
    feed = change_feed(ev, key="event_id", table="events", db="app", ts_col="ts")
    batch = parse_changes(feed, EVENTS_SCHEMA)
    return as_ntz(apply_batch(batch, JobSpec(name=EVENTS_VIEW, output=OutputSpec(sql=HOURLY_SQL))))


def select_columns_partial(spark, sf):
    job = JobSpec(name=ORDERS_VIEW,
                  output=OutputSpec(columns=["o_totalprice", "no_such_column", "o_orderkey", "op"]))
    return apply_batch(_orders_batch(spark, sf), job)


def phone_normalize(spark, sf):
    ready(spark)
    register_functions(spark)
    batch = parse_changes(customer_feed(spark, sf), CUSTOMER_TYPED_SCHEMA)
    return apply_batch(batch, JobSpec(name=CUSTOMERS_VIEW, output=OutputSpec(sql=PHONE_SQL)))


QUERIES = {name: _sql_query(sql) for name, sql in SQL.items()}
QUERIES["sql_filter_project"] = _sql_query(
    SQL["sql_filter_project"], columns=["o_totalprice", "no_such_column", "o_orderkey", "op"])
QUERIES["sql_latest_per_key"] = _sql_query(LATEST_SQL)
QUERIES["sql_pricing_summary"] = sql_pricing_summary
QUERIES["sql_hourly_events"] = sql_hourly_events
QUERIES.update({name: _lineitem_query(sql) for name, sql in WINDOW_SQL.items()})
QUERIES["select_columns_partial"] = select_columns_partial
QUERIES["phone_normalize"] = phone_normalize

ORACLES = {name: _ORACLE_VIEWS + sql for name, sql in SQL.items()}
ORACLES["sql_pipe_twice"] = ORACLES["sql_table_twice"]
ORACLES["sql_filter_project"] = (
    _ORACLE_VIEWS + f"select o_totalprice, o_orderkey, op from ({SQL['sql_filter_project']})")
ORACLES["sql_subquery_cte"] = (
    _ORACLE_VIEWS + f", spend as (select o_custkey, sum(o_totalprice) as s from {ORDERS_VIEW} "
    "group by o_custkey) select o_custkey, round(s, 2) as spend from spend "
    "where s > (select avg(s) from spend)")
ORACLES["sql_custom_function"] = (
    _ORACLE_VIEWS + f"select o_orderkey, o_totalprice * (1 - 0.25) as net from {ORDERS_VIEW} "
    "where op <> 'd'")
ORACLES["sql_latest_per_key"] = LATEST_ORACLE
ORACLES["select_columns_partial"] = (
    _ORACLE_VIEWS + f"select o_totalprice, o_orderkey, op from {ORDERS_VIEW}")
ORACLES["phone_normalize"] = PHONE_ORACLE
ORACLES["sql_hourly_events"] = (
    f"WITH {EVENTS_VIEW} AS (SELECT event_id, ts, user_id, event_type, value, "
    f"{op_sql('event_id')} AS op FROM events) " + HOURLY_SQL)
_LINEITEM_VIEW_SQL = (
    f"WITH {LINEITEM_VIEW} AS (SELECT *, {op_sql('(l_orderkey * 8 + l_linenumber)')} AS op FROM lineitem) ")
ORACLES["sql_pricing_summary"] = _LINEITEM_VIEW_SQL + PRICING_SQL
ORACLES.update({name: _LINEITEM_VIEW_SQL + sql for name, sql in WINDOW_SQL.items()})
