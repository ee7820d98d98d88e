"""Benchmark: change-record parse, operation filter, metadata lift, per-batch SQL
and the stream end to end, over change feeds built from the ``lineitem`` and
``orders`` tables at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

The feeds are built once and written as parquet (``key``, ``value``) and as
JSON text files; that staging is reported but not counted.  Every timed query
runs over every record (a ``noop`` sink forces full evaluation without
collecting rows), best of ``$BENCH_REPEAT`` runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession, functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from tidemark import (  # noqa: E402
    JobSpec, OutputSpec, SourceSpec, apply_batch, filter_by_operation, lift_metadata,
    parse_changes, prepare_session, run_job, shared_dir,
)
from tidemark.operators.ordered import running_totals  # noqa: E402
from tidemark.sources.feed import change_feed  # noqa: E402
from tidemark.streaming.runner import register_lookup_tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
# set BENCH_UDF_BASELINE=1 to also time a row-at-a-time Python UDF parse
# (reported apart, not part of the total)
UDF_BASELINE = os.environ.get("BENCH_UDF_BASELINE", "") == "1"
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))

LINEITEM = [
    ("l_orderkey", "long"), ("l_partkey", "long"), ("l_suppkey", "long"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp"),
]

JOIN_SQL = (
    "select p.p_brand, c.op, count(*) as n, sum(c.l_extendedprice) as revenue "
    "from lineitem_changes c join dim_part p on c.l_partkey = p.p_partkey "
    "where c.op <> 'd' group by p.p_brand, c.op")

Q1_SQL = (
    "select op, l_returnflag, l_linestatus, count(*) as n, sum(l_quantity) as sum_qty, "
    "sum(l_extendedprice * (1 - l_discount)) as revenue, avg(l_discount) as avg_disc "
    "from lineitem_changes group by op, l_returnflag, l_linestatus")


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]")
             .appName("tidemark-bench")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", str(CPUS))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    return spark


def best(fn, repeat: int = REPEAT) -> float:
    times = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t)
    return min(times)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def python_udf_parse(records):
    """Baseline only: the same parse as a per-row Python function."""
    import json as _json

    from pyspark.sql import types as T

    names = [n for n, _ in LINEITEM]
    pytypes = {"long": T.LongType(), "int": T.LongType(), "double": T.DoubleType()}
    st = T.StructType([T.StructField(n, pytypes.get(t, T.StringType())) for n, t in LINEITEM]
                      + [T.StructField("op", T.StringType())])

    def parse(value):
        try:
            rec = _json.loads(value)
        except Exception:
            return None
        if not isinstance(rec, dict):
            return None
        op = rec.get("op", "")
        img = rec.get("before") if op == "d" else rec.get("after")
        if not isinstance(img, dict):
            return tuple([None] * len(names)) + (op,)
        return tuple(img.get(n) for n in names) + (op,)

    return records.select(F.udf(parse, st)("value").alias("r")).select("r.*")


def main() -> None:
    spark = session()
    work = shared_dir(spark, "tidemark", "bench", unique=True)

    t0 = time.perf_counter()
    li = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    # (order, line number) is the row key; line numbers stay below 8
    keyed = li.withColumn("change_id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    feed = change_feed(keyed, key="change_id", table="lineitem", ts_col="l_shipdate",
                       before_changes={"l_quantity": F.col("l_quantity") + F.lit(1.0)})
    feed.write.mode("overwrite").parquet(f"{work}/feed")
    records = spark.read.parquet(f"{work}/feed")
    n_records = records.count()
    # two micro-batches' worth of files: one file per core per trigger
    records.select("value").repartition(2 * CPUS).write.mode("overwrite").text(f"{work}/stream_in")
    stage_sec = time.perf_counter() - t0

    queries: dict[str, float] = {}
    queries["parse"] = best(lambda: noop(parse_changes(records, LINEITEM, keep=["key"])))
    # operation filter on raw records (the records themselves are kept) ...
    queries["filter_raw"] = best(lambda: noop(filter_by_operation(records, ["c", "u"])))
    # ... and decided on the parsed op, before any image is cast
    queries["parse_upserts"] = best(lambda: noop(
        parse_changes(records, LINEITEM, operations=["c", "u"])))
    queries["metadata"] = best(lambda: noop(lift_metadata(records).drop("value")))

    def sql_q1():
        job = JobSpec(name="lineitem_changes", output=OutputSpec(sql=Q1_SQL))
        apply_batch(parse_changes(records, LINEITEM), job).collect()
    queries["sql_aggregate"] = best(sql_q1)

    register_lookup_tables(spark, {"dim_part": f"{SF_DIR}/part.parquet"})

    def sql_join():
        job = JobSpec(name="lineitem_changes", output=OutputSpec(sql=JOIN_SQL))
        apply_batch(parse_changes(records, LINEITEM), job).collect()
    queries["sql_join_lookup"] = best(sql_join)

    def running():
        parsed = parse_changes(records, LINEITEM)
        noop(running_totals(parsed, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"],
                            "l_quantity"))
    queries["running_totals"] = best(running)

    def stream():
        run_dir = shared_dir(spark, "tidemark", "bench", "stream", unique=True)
        spec = JobSpec(
            name="lineitem_changes", schema=LINEITEM,
            source=SourceSpec(kind="files", path=f"{work}/stream_in", max_files_per_trigger=CPUS),
            output=OutputSpec(path=f"{run_dir}/out"),
            checkpoint_location=f"{run_dir}/checkpoint")
        run_job(spark, spec, available_now=True)
    queries["stream_end_to_end"] = best(stream, repeat=max(1, REPEAT - 1))

    baseline = {}
    if UDF_BASELINE:
        baseline["parse_python_udf"] = round(best(lambda: noop(python_udf_parse(records)), 1), 3)

    total = sum(queries.values())
    out = {
        "metric": "total_query_time",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in queries.items()},
        "rows_per_sec": {k: round(n_records / v) for k, v in queries.items()},
        "records": n_records,
        "stage_sec": round(stage_sec, 3),
        "cpus": CPUS,
        **({"baseline": baseline} if baseline else {}),
        "sf": os.path.basename(SF_DIR).replace("sf", ""),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
