"""As-of join: each left row with the latest right row of its key at or before its time.

A join on ``key`` and ``right.time <= left.time`` would compare every pair of a key
before it keeps one; a window over the union of both sides would put a whole key into
one task.  Here the two sides are merged in order instead:

1. both sides, tagged, are range-partitioned on (key, time): the bounds come from a
   sample, so a hot key is cut into many pieces.  The rows are written once with
   their range partition, in the shared folder, so every later step and every retry
   sees the same cut;
2. within a piece (range partition, key), the last right row so far is carried along
   the order by a window: no group is larger than a range partition;
3. what a piece inherits from the pieces before it is one right row: the last one of
   its key.  A frame with one row per range partition works that out, and goes back by
   a broadcast that is bounded by the number of partitions, not by the data.

Rows: a left row with a null key or time has no match; right rows with one are no
candidates.  Of right rows with equal key and time the greatest wins (by their further
columns in order, nulls first).  Repeated left rows are matched each.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import shared_dir
from .ordered import partitions_for

_PID, _KEY, _TIME, _SIDE, _LEFT, _RIGHT = (f"__tm_{n}" for n in ("pid", "key", "time", "side", "left", "right"))


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def asof_join(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str], left_time: str,
              right_time: str, columns: Sequence[str], *, how: str = "left", strict: bool = False,
              num_partitions: int | None = None) -> DataFrame:
    """``left`` with ``columns`` of the latest right row of the same key whose time is
    not after the left row's (before it, when ``strict``); nulls where there is none,
    or no row at all for ``how="inner"``.

    ``on`` maps left to right key columns, or names columns that both sides have."""
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner: {how!r}")
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    clash = {c.lower() for c in columns} & {c.lower() for c in left.columns}
    if clash or not pairs or not columns:
        raise ValueError(f"an as-of join needs keys, and right columns that the left side does not have: {sorted(clash)}")
    spark = left.sparkSession
    # equal names on both sides of the key struct, so that the sides can be put together
    key_l = F.struct(*[_col(a).alias(f"k{i}") for i, a in enumerate(pairs)])
    key_r = F.struct(*[_col(b).alias(f"k{i}") for i, b in enumerate(pairs.values())])
    picked = F.struct(*[_col(c) for c in columns])
    whole = F.struct(*[_col(c) for c in left.columns])

    def placed(df: DataFrame, keys, time: str) -> Column:
        cond = _col(time).isNotNull()
        for k in keys:
            cond = cond & _col(k).isNotNull()
        return cond

    # at one time: right rows first, or last when only earlier ones count
    l_rank, r_rank = (0, 1) if strict else (1, 0)
    fits = placed(left, pairs, left_time)
    l_rows = left.filter(fits).select(key_l.alias(_KEY), _col(left_time).alias(_TIME), F.lit(l_rank).alias(_SIDE),
                                      whole.alias(_LEFT))
    r_rows = right.filter(placed(right, pairs.values(), right_time)).select(
        key_r.alias(_KEY), _col(right_time).alias(_TIME), F.lit(r_rank).alias(_SIDE), picked.alias(_RIGHT))
    both = l_rows.unionByName(r_rows, allowMissingColumns=True)

    order = [_KEY, _TIME, _SIDE, _RIGHT]
    n = num_partitions or partitions_for(both)
    path = shared_dir(spark, "tidemark", "asof", unique=True, temporary=True)
    (both.repartitionByRange(n, *order).withColumn(_PID, F.spark_partition_id())
     .write.mode("overwrite").parquet(path))
    rows = spark.read.schema(both.schema.add(_PID, "integer")).parquet(path)

    so_far = Window.partitionBy(_PID, _KEY).orderBy(_TIME, _SIDE, _RIGHT).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("__tm_last", F.last(_RIGHT, ignorenulls=True).over(so_far)).filter(F.col(_SIDE) == l_rank)

    # per range partition: its first and last key, and the last right row of the last key
    per_key = rows.groupBy(_PID, _KEY).agg(
        F.max(F.when(F.col(_SIDE) == r_rank, F.struct(_TIME, _RIGHT))).alias("tail"))
    ends = per_key.groupBy(_PID).agg(F.min(_KEY).alias("first_key"), F.max(_KEY).alias("last_key"),
                                     F.max_by(F.struct("tail"), F.col(_KEY)).getField("tail").alias("tail"))
    by_pid = Window.orderBy(_PID)
    up_to = by_pid.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = ends.withColumn("run", F.sum(F.when(F.lag("last_key").over(by_pid).eqNullSafe(F.col("last_key")), 0)
                                        .otherwise(1)).over(up_to))
    runs = runs.withColumn("held", F.last("tail", ignorenulls=True).over(
        Window.partitionBy("run").orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    carry = (runs.select(_PID, "first_key", F.lag("last_key").over(by_pid).alias("before"),
                         F.lag("held").over(by_pid).alias("held"))
             .filter(F.col("before").eqNullSafe(F.col("first_key")) & F.col("held").isNotNull())
             .select(_PID, F.col("first_key").alias("__tm_first"), F.col(f"held.{_RIGHT}").alias("__tm_carried")))

    joined = local.join(F.broadcast(carry), _PID, "left")
    match = F.coalesce("__tm_last", F.when(F.col(_KEY) == F.col("__tm_first"), F.col("__tm_carried")))
    out = joined.select(F.col(_LEFT), match.alias(_RIGHT))
    if how == "inner":
        out = out.filter(F.col(_RIGHT).isNotNull())
    out = out.select(f"{_LEFT}.*", f"{_RIGHT}.*")
    if how == "inner":
        return out
    lone = left.filter(~F.coalesce(fits, F.lit(False)))
    return out.unionByName(lone.select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns]))
