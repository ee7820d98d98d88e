"""Registered queries for what goes across micro-batches: the current-state table,
event-time windows, sessions, deduplication, interval joins and late rows.

Every query writes change records built from a table as text files, in several sets
under one folder, and runs its job after each set on the same checkpoint: each run is
a restart, and state has to come from the checkpoint.  Sets follow event time where
the watermark matters; a last record far in the future (a heartbeat) lets the
watermark pass every row, so that what the job has emitted is all there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.event_time import interval_join, with_watermark
from ..operators.parse import parse_changes
from ..operators.sketches import KLL_K, LG_K, estimates, hll_error, kll_error, merge_sketches
from ..session import ONE_COPY, SHUFFLE_CLEANUP, prepare_session, settings, uncounted_state, use_rocksdb
from ..sinks.current import read_current
from ..sinks.evolve import read_evolved
from ..sources.change_stream import read_change_stream
from ..sources.feed import change_feed, epoch_millis
from ..spec import EventTimeSpec, JobSpec, OutputSpec, SourceSpec
from ..streaming.chains import BROKEN, broken_chains
from ..streaming.runner import run_job
from .common import ORDERS_SCHEMA, as_ntz, ready, table
from .streams import _workdir

SETS = 4
HEARTBEAT = "heartbeat"
FAR = "2100-01-01 00:00:00"


def _record(after: Column, before: Column, op: Column, ts_ms: Column, pos: Column) -> Column:
    source = F.struct(F.lit("tpch").alias("db"), F.lit("orders").alias("table"), pos.alias("pos"))
    return F.to_json(F.struct(before.alias("before"), after.alias("after"), source.alias("source"),
                              op.alias("op"), ts_ms.alias("ts_ms")), {"ignoreNullFields": "false"}).alias("value")


# ---- current state -------------------------------------------------------------

STATE_SCHEMA = [{"name": "o_orderkey", "type": "long"}, {"name": "o_custkey", "type": "long"},
                {"name": "o_orderstatus", "type": "string"}, {"name": "o_totalprice", "type": "double"}]
_CHANGES = 4     # most changes of an order: key % 4 + 1 of them


def order_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every order's changes as records: change ``i`` raises the price by ``i``; the last
    one of every fifth order is a delete.  Two neighbours share a ``ts_ms``, so the
    position in the source decides between them.  ``part`` deals the changes out
    regardless of their order."""
    ready(spark)
    i, k = F.col("i"), F.col("o_orderkey")
    o = (table(spark, sf, "orders")
         .withColumn("i", F.explode(F.sequence(F.lit(0), F.pmod(k, F.lit(_CHANGES)))))
         .withColumn("last", i == F.pmod(k, F.lit(_CHANGES))))
    row = F.struct(k.alias("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"),
                   (F.col("o_totalprice") + i).alias("o_totalprice"))
    gone = F.col("last") & (F.pmod(k, F.lit(5)) == 0)
    op = F.when(gone, "d").when(i == 0, "c").otherwise("u")
    ts = epoch_millis(F.col("o_orderdate")) + F.floor(i / 2).cast("bigint") * 1000
    return o.select(F.pmod(k + i, F.lit(SETS)).alias("part"),
                    _record(F.when(~gone, row), F.when(gone, row), op, ts, k * 10 + i))


def _state_job(work: str) -> JobSpec:
    return JobSpec(
        name=f"state_{work.rsplit('/', 1)[-1]}", schema=STATE_SCHEMA,
        envelope={"ts_ms": "bigint", "source.pos": "bigint"},
        source=SourceSpec(kind="files", path=f"{work}/in"),
        output=OutputSpec(path=f"{work}/out", upsert_keys=["o_orderkey"], upsert_order=["ts_ms", "pos"], buckets=16),
        checkpoint_root=work, catalog="spark_catalog")


def stream_upsert(spark, sf):
    """Orders' changes in several batches, out of order, one set of them twice."""
    work = _workdir(spark, "upsert")
    feed = order_history(spark, sf)
    for part in (2, 0, 3, 2, 1):       # set 2 is replayed
        feed.filter(F.col("part") == part).select("value").write.mode("append").text(f"{work}/in")
        run_job(spark, _state_job(work), available_now=True)
    return read_current(spark, f"{work}/out").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "op", "pos")


def stream_truncate(spark, sf):
    """A truncate hides the rows before it, in whichever order they come."""
    work = _workdir(spark, "truncate")
    feed = order_history(spark, sf)
    none = F.lit(None).cast("string")
    at = epoch_millis(F.lit(TRUNCATED).cast("timestamp_ntz"))
    cut = spark.range(1).select(_record(none, none, F.lit("t"), at, F.lit(0).cast("bigint")))
    for part in (1, 3, 0, 2):
        rows = feed.filter(F.col("part") == part).select("value")
        (rows if part != 3 else rows.unionAll(cut)).write.mode("append").text(f"{work}/in")
        run_job(spark, _state_job(work), available_now=True)
    return read_current(spark, f"{work}/out").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


TRUNCATED = "1998-06-01 00:00:00"


# ---- event time ----------------------------------------------------------------

EVENT_SCHEMA = [{"name": "event_id", "type": "long"}, {"name": "ts", "type": "timestamp"},
                {"name": "user_id", "type": "long"}, {"name": "event_type", "type": "string"},
                {"name": "value", "type": "double"}]


def _sets(df: DataFrame, column: str, sets: int = SETS) -> DataFrame:
    """``df`` with ``part``: the range of ``column``, cut into equal spans."""
    at = F.unix_micros(F.col(column).cast("timestamp"))
    lo, hi = df.agg(F.min(at), F.max(at)).first()       # two numbers; none for an empty table
    lo, step = lo or 0, max(((hi or 0) - (lo or 0)) / sets, 1.0)
    return df.withColumn("part", F.least(F.floor((at - F.lit(lo)) / F.lit(step)), F.lit(sets - 1)).cast("int"))


def event_feed(spark: SparkSession, sf: str, repeats: bool = False) -> DataFrame:
    """Records of ``events`` (all creates) with the ``part`` they are delivered in;
    ``repeats`` delivers every third event again in the same set and every fourth
    again in the next."""
    ready(spark)
    rows = _sets(table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value"), "ts")
    if repeats:
        k = F.col("event_id")
        rows = rows.unionAll(rows.filter(F.pmod(k, F.lit(3)) == 0)).unionAll(
            rows.filter(F.pmod(k, F.lit(4)) == 0).withColumn("part", F.least(F.col("part") + 1, F.lit(SETS - 1))))
    record = change_feed(rows.drop("part"), key="event_id", table="events", ts_col="ts", ops=("c",))
    if not repeats:
        return record.join(rows.select(F.col("event_id").cast("string").alias("key"), "part"), "key")
    keyed = rows.select(F.col("event_id").cast("string").alias("key"), "part")
    return record.dropDuplicates(["key"]).join(keyed, "key")


def heartbeat(spark: SparkSession, columns: dict[str, str]) -> DataFrame:
    """One record in the far future."""
    row = F.struct(*[F.lit(v).alias(k) for k, v in columns.items()])
    none = F.lit(None).cast("string")
    return spark.range(1).select(_record(row, none, F.lit("c"), epoch_millis(F.lit(FAR).cast("timestamp_ntz")), none))


def _event_job(work: str, event_time: EventTimeSpec, sql: str | None = None, **output) -> JobSpec:
    return JobSpec(
        name=f"events_{work.rsplit('/', 1)[-1]}", schema=EVENT_SCHEMA, source=SourceSpec(kind="files", path=f"{work}/in"),
        output=OutputSpec(sql=sql, temp_view="events_changes", path=f"{work}/out", **output),
        event_time=event_time, checkpoint_root=work, catalog="spark_catalog")


def _run_sets(spark, feed: DataFrame, work: str, job: JobSpec, beat: bool = True) -> None:
    staged = feed.write.mode("overwrite").partitionBy("part")
    staged.parquet(f"{work}/feed")
    for part in range(SETS):
        rows = spark.read.schema("key string, value string, part int").parquet(f"{work}/feed").filter(F.col("part") == part)
        rows.select("value").write.mode("append").text(f"{work}/in")
        run_job(spark, job, available_now=True)
    if beat:
        heartbeat(spark, {"event_type": HEARTBEAT, "ts": FAR}).write.mode("append").text(f"{work}/in")
        run_job(spark, job, available_now=True)


AGGREGATES = {"n": "count(*)", "total": "round(sum(value), 2)"}


def stream_window_tumbling(spark, sf):
    """Hourly counts by type; a window is emitted once, when the watermark has passed it."""
    work = _workdir(spark, "tumbling")
    job = _event_job(work, EventTimeSpec(column="ts", delay="10 minutes", window="1 hour", keys=["event_type"],
                                         aggregates=AGGREGATES))
    _run_sets(spark, event_feed(spark, sf), work, job)
    return as_ntz(spark.read.parquet(f"{work}/out"))


def stream_window_sliding(spark, sf):
    """Six-hour windows every two hours; without a heartbeat, so the last windows stay
    in the state: emitted are those that end at or before the watermark."""
    work = _workdir(spark, "sliding")
    job = _event_job(work, EventTimeSpec(column="ts", delay="30 minutes", window="6 hours", slide="2 hours",
                                         aggregates=AGGREGATES))
    _run_sets(spark, event_feed(spark, sf), work, job, beat=False)
    return as_ntz(spark.read.parquet(f"{work}/out"))


def stream_sessions(spark, sf):
    """Sessions per user, two hours apart; they span the sets."""
    work = _workdir(spark, "sessions")
    job = _event_job(work, EventTimeSpec(column="ts", delay="5 minutes", session_gap="2 hours", keys=["user_id"],
                                         aggregates=AGGREGATES), sql="select * from events_changes where user_id is not null")
    _run_sets(spark, event_feed(spark, sf), work, job)
    return as_ntz(spark.read.parquet(f"{work}/out"))


def stream_dedup(spark, sf):
    """A feed with repeats in the same set, in later sets and after restarts: each change once."""
    work = _workdir(spark, "dedup")
    job = _event_job(work, EventTimeSpec(column="ts", delay="3650 days", dedup=["event_id"]))
    _run_sets(spark, event_feed(spark, sf, repeats=True), work, job, beat=False)
    return as_ntz(spark.read.parquet(f"{work}/out"))


def stream_late_rows(spark, sf):
    """Every seventh event is delivered a set after its time: on time and late rows add up."""
    work = _workdir(spark, "late")
    job = _event_job(work, EventTimeSpec(column="ts", delay="1 hour"), late_path=f"{work}/late")
    feed = event_feed(spark, sf)
    held = F.pmod(F.col("key").cast("bigint"), F.lit(7)) == 0
    feed = feed.withColumn("part", F.when(held, F.least(F.col("part") + 1, F.lit(SETS - 1))).otherwise(F.col("part")))
    _run_sets(spark, feed, work, job, beat=False)
    both = [spark.read.parquet(f"{work}/{p}").withColumn("late", F.lit(p == "late")).drop("_query_id", "_batch_id")
            for p in ("out", "late")]
    return as_ntz(both[0].unionByName(both[1]).select("event_id", "ts", "user_id", "event_type", "value", "late"))


# ---- interval join -------------------------------------------------------------

ORDER_SIDE = [{"name": "o_orderkey", "type": "long"}, {"name": "o_custkey", "type": "long"},
              {"name": "o_orderdate", "type": "timestamp"}]
LINE_SIDE = [{"name": "l_orderkey", "type": "long"}, {"name": "l_linenumber", "type": "int"},
             {"name": "l_quantity", "type": "double"}, {"name": "l_shipdate", "type": "timestamp"}]
UPPER = "120 days"


def _join_once(spark, work: str, how: str, salts: int) -> None:
    def side(folder, schema, column):
        raw = read_change_stream(spark, SourceSpec(kind="files", path=f"{work}/{folder}"))
        return with_watermark(parse_changes(raw, schema).drop("op"), column, "1 day")

    joined = interval_join(side("orders", ORDER_SIDE, "o_orderdate"), side("lines", LINE_SIDE, "l_shipdate"),
                           {"o_orderkey": "l_orderkey"}, "o_orderdate", "l_shipdate", "0 days", UPPER, how=how, salts=salts)
    with uncounted_state(spark), settings(spark, {**ONE_COPY, **SHUFFLE_CLEANUP}):
        q = (joined.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{work}/checkpoint")
             .trigger(availableNow=True).start(f"{work}/out"))
    q.awaitTermination()


def _interval(spark, sf, how: str, salts: int = 1) -> DataFrame:
    ready(spark)
    prepare_session(spark)
    use_rocksdb(spark)
    work = _workdir(spark, f"interval-{how}")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    cut = F.lit("1998-03-01").cast("timestamp_ntz")
    for first in (True, False):      # the feeds' two halves, by event time, with a restart in between
        for df, column, key, name, beat in ((orders, "o_orderdate", "o_orderkey", "orders", {"o_orderkey": "-1", "o_orderdate": FAR}),
                                            (lines, "l_shipdate", "l_orderkey", "lines", {"l_orderkey": "-2", "l_shipdate": FAR})):
            half = df.filter((F.col(column) < cut) if first else (F.col(column) >= cut))
            feed = change_feed(half, key=key, table=name, ts_col=column, ops=("c",)).select("value")
            with settings(spark, SHUFFLE_CLEANUP):      # records as text are ten times the table: compressed
                feed.write.mode("append").option("compression", "gzip").text(f"{work}/{name}")
        _join_once(spark, work, how, salts)
    for name, beat in (("orders", {"o_orderkey": "-1", "o_orderdate": FAR}), ("lines", {"l_orderkey": "-2", "l_shipdate": FAR})):
        heartbeat(spark, beat).write.mode("append").text(f"{work}/{name}")
    _join_once(spark, work, how, salts)
    return as_ntz(spark.read.parquet(f"{work}/out"))


def stream_interval_join(spark, sf):
    """Line items shipped within 120 days of their order, both as feeds, with a restart."""
    return _interval(spark, sf, "inner", salts=2)


def stream_interval_join_outer(spark, sf):
    """The same, and orders without such a line once none can come."""
    return _interval(spark, sf, "left_outer")


# ---- broken chains ---------------------------------------------------------------

DAY_MS = 86_400_000
DAY_ZERO = "2024-01-01 00:00:00"


def customer_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Four changes of every customer's balance, two days apart; the before image of
    change ``c_custkey % 4`` of every eleventh customer is not what the last one left."""
    ready(spark)
    k, i = F.col("c_custkey"), F.col("part")
    rows = table(spark, sf, "customer").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(3))))
    image = lambda balance: F.struct(k.alias("c_custkey"), F.col("c_name"), balance.alias("c_acctbal"))
    wrong = (F.pmod(k, F.lit(11)) == 0) & (F.pmod(k, F.lit(4)) == i)
    before = F.when(i > 0, image(F.col("c_acctbal") + (i - 1) + F.when(wrong, 0.5).otherwise(0.0)))
    ts = epoch_millis(F.lit(DAY_ZERO).cast("timestamp_ntz")) + i * 2 * DAY_MS + F.pmod(k, F.lit(1000))
    return rows.select("part", _record(image(F.col("c_acctbal") + i), before, F.when(i == 0, "c").otherwise("u"), ts, k * 10 + i))


def stream_broken_chains(spark, sf):
    """The planted breaks, found although the third changes come before the second, with a
    restart after every set."""
    prepare_session(spark)
    use_rocksdb(spark)
    work = _workdir(spark, "chains")
    feed = customer_chains(spark, sf)

    def run_once():
        raw = read_change_stream(spark, SourceSpec(kind="files", path=f"{work}/in"))
        (broken_chains(raw, "c_custkey", "3 days").writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start(f"{work}/out").awaitTermination())

    for part in (0, 2, 1, 3):
        feed.filter(F.col("part") == part).select("value").write.mode("append").text(f"{work}/in")
        run_once()
    heartbeat(spark, {"c_custkey": "-1"}).write.mode("append").text(f"{work}/in")
    run_once()
    return spark.read.schema(BROKEN).parquet(f"{work}/out")


# ---- schema evolution, sketches ---------------------------------------------------

def stream_schema_evolution(spark, sf):
    """A job over the first half of the orders; then, on the same checkpoint, with two more
    fields and a wider type over the second: one table."""
    ready(spark)
    work = _workdir(spark, "evolve")
    first = [{"name": "o_orderkey", "type": "int"}, {"name": "o_totalprice", "type": "double"}]
    second = [{"name": "o_orderkey", "type": "long"}, {"name": "o_custkey", "type": "long"},
              {"name": "o_totalprice", "type": "double"}, {"name": "o_orderdate", "type": "timestamp"}]
    for half, schema in enumerate((first, second)):
        rows = table(spark, sf, "orders").filter(F.pmod(F.col("o_orderkey"), F.lit(2)) == half)
        change_feed(rows, key="o_orderkey", table="orders", ops=("c",)).select("value").write.mode("append").text(f"{work}/in")
        run_job(spark, JobSpec(name=f"evolve_{work.rsplit('/', 1)[-1]}", schema=schema,
                               source=SourceSpec(kind="files", path=f"{work}/in"),
                               output=OutputSpec(path=f"{work}/out", evolve=True), checkpoint_root=work,
                               catalog="spark_catalog"), available_now=True)
    return as_ntz(read_evolved(spark, f"{work}/out"))


def _sketches(spark, sf) -> DataFrame:
    """Sketches per batch of the orders feed, written by the job's own SQL."""
    ready(spark)
    work = _workdir(spark, "sketches")
    change_feed(table(spark, sf, "orders"), key="o_orderkey", table="orders", ops=("c",),
                num_partitions=SETS).select("value").write.mode("append").text(f"{work}/in")
    sql = (f"select o_orderstatus, o_orderpriority, count(*) as rows, hll_sketch_agg(o_custkey, {LG_K}) as o_custkey_distinct, "
           f"kll_sketch_agg_double(o_totalprice, {KLL_K}) as o_totalprice_quantiles from orders_changes group by all")
    run_job(spark, JobSpec(name=f"sketches_{work.rsplit('/', 1)[-1]}", schema=ORDERS_SCHEMA,
                           source=SourceSpec(kind="files", path=f"{work}/in", max_files_per_trigger=1),
                           output=OutputSpec(sql=sql, temp_view="orders_changes", path=f"{work}/out"),
                           checkpoint_root=work, catalog="spark_catalog"), available_now=True)
    return spark.read.parquet(f"{work}/out")


def stream_sketch_distinct(spark, sf):
    """Customers per status: the merged estimate lies within the stated error of the exact count."""
    merged = estimates(merge_sketches(_sketches(spark, sf), ["o_orderstatus"]))
    exact = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("exact"))
    off = F.abs(F.col("o_custkey_distinct") - F.col("exact"))
    return merged.join(exact, "o_orderstatus").select(
        "o_orderstatus", F.col("rows").alias("n"), "exact", (off <= F.col("exact") * hll_error()).alias("within"))


def stream_sketch_median(spark, sf):
    """Median price per priority: its rank among the group's prices is within the stated error of a half."""
    merged = estimates(merge_sketches(_sketches(spark, sf), ["o_orderpriority"]))
    ranked = (table(spark, sf, "orders").join(merged.select("o_orderpriority", "o_totalprice_median"), "o_orderpriority")
              .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"),
                                              F.avg((F.col("o_totalprice") <= F.col("o_totalprice_median")).cast("double")).alias("rank")))
    return ranked.select("o_orderpriority", "n", (F.abs(F.col("rank") - 0.5) <= kll_error()).alias("within"))


QUERIES = {
    "stream_broken_chains": stream_broken_chains,
    "stream_schema_evolution": stream_schema_evolution,
    "stream_sketch_distinct": stream_sketch_distinct,
    "stream_sketch_median": stream_sketch_median,
    "stream_upsert": stream_upsert,
    "stream_truncate": stream_truncate,
    "stream_window_tumbling": stream_window_tumbling,
    "stream_window_sliding": stream_window_sliding,
    "stream_sessions": stream_sessions,
    "stream_dedup": stream_dedup,
    "stream_late_rows": stream_late_rows,
    "stream_interval_join": stream_interval_join,
    "stream_interval_join_outer": stream_interval_join_outer,
}

_LAST = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + o_orderkey % {_CHANGES} AS o_totalprice,
  CASE WHEN o_orderkey % {_CHANGES} = 0 THEN 'c' ELSE 'u' END AS op, o_orderkey * 10 + o_orderkey % {_CHANGES} AS pos,
  epoch_ms(o_orderdate) + (o_orderkey % {_CHANGES}) // 2 * 1000 AS at_ms FROM orders WHERE o_orderkey % 5 <> 0"""
_EVENT_SETS = f"""e AS (SELECT event_id, ts, user_id, event_type, value, least(floor((epoch_us(ts) - lo) / greatest((hi - lo) / {SETS}.0, 1.0)), {SETS - 1})::INT AS part
  FROM events, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events))"""
_JOIN = f"FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL {UPPER}"
_JOIN_COLUMNS = "o_orderkey, o_custkey, o_orderdate, l_orderkey, l_linenumber, l_quantity, l_shipdate"

ORACLES = {
    "stream_broken_chains": (
        f"SELECT c_custkey::VARCHAR AS key, epoch_ms(TIMESTAMP '{DAY_ZERO}') + i * 2 * {DAY_MS} + c_custkey % 1000 AS ts_ms, "
        "c_custkey * 10 + i AS pos, 'u' AS op FROM (SELECT c_custkey, c_custkey % 4 AS i FROM customer "
        "WHERE c_custkey % 11 = 0 AND c_custkey % 4 > 0)"),
    "stream_schema_evolution": (
        "SELECT o_orderkey, o_totalprice, 'c' AS op, CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS o_custkey, "
        "CASE WHEN o_orderkey % 2 = 1 THEN o_orderdate END AS o_orderdate FROM orders"),
    "stream_sketch_distinct": ("SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS exact, true AS within "
                               "FROM orders GROUP BY 1"),
    "stream_sketch_median": "SELECT o_orderpriority, count(*) AS n, true AS within FROM orders GROUP BY 1",
    "stream_upsert": f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, op, pos FROM ({_LAST})",
    "stream_truncate": ("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total "
                        f"FROM ({_LAST}) WHERE at_ms > epoch_ms(TIMESTAMP '{TRUNCATED}') "
                        f"OR (at_ms = epoch_ms(TIMESTAMP '{TRUNCATED}') AND pos > 0) GROUP BY 1"),
    "stream_window_tumbling": (
        "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, "
        "count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL"),
    "stream_window_sliding": (
        "SELECT w AS window_start, w + INTERVAL 6 HOUR AS window_end, count(*) AS n, round(sum(value), 2) AS total "
        "FROM (SELECT value, unnest([time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 4 HOUR, time_bucket(INTERVAL 2 HOUR, ts) "
        "- INTERVAL 2 HOUR, time_bucket(INTERVAL 2 HOUR, ts)]) AS w FROM events) GROUP BY w "
        "HAVING w + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 30 MINUTE"),
    "stream_sessions": (
        "WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events "
        "WINDOW w AS (PARTITION BY user_id ORDER BY ts)), "
        "s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g) "
        "SELECT min(ts) AS window_start, max(ts) + INTERVAL 2 HOUR AS window_end, user_id, count(*) AS n, "
        "round(sum(value), 2) AS total FROM s GROUP BY user_id, sid"),
    "stream_dedup": "SELECT event_id, ts, user_id, event_type, value, 'c' AS op FROM events",
    "stream_late_rows": (
        f"WITH {_EVENT_SETS}, d AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN least(part + 1, {SETS - 1}) ELSE part END AS given FROM e), "
        "m AS (SELECT given, max(ts) AS top FROM d GROUP BY 1) "
        "SELECT event_id, ts, user_id, event_type, value, coalesce(ts < (SELECT max(top) FROM m WHERE m.given < d.given) "
        "- INTERVAL 1 HOUR, false) AS late FROM d"),
    "stream_interval_join": f"SELECT {_JOIN_COLUMNS} {_JOIN}",
    "stream_interval_join_outer": f"SELECT {_JOIN_COLUMNS} {_JOIN.replace(' JOIN ', ' LEFT JOIN ')}",
}
