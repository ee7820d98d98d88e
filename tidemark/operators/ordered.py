"""Position and running total of each row within its key, in a given order,
without putting a whole key into one task.

A plain ``row_number() / sum() OVER (PARTITION BY key ORDER BY ...)`` sends
every row of a key to one task: a key holding a third of the data makes that
task a third of the job.  Here the work is split by position instead:

1. ``repartitionByRange`` on (key, order): the range bounds come from a sample
   of (key, order) values, so a hot key is cut into many contiguous pieces,
   one per range partition.  The rows, tagged with their range partition, are
   written once as parquet in the shared checkpoint folder: both later steps
   read the same assignment (a range exchange computed twice may sample
   different bounds), and lost executors cannot change it;
2. a window over (range partition, key) numbers and sums each piece; every
   such group is at most one range partition, so the tasks stay balanced;
3. a per-partition summary (at most one row per range partition: its first
   key, its last key and the last key's count and sum, from hash aggregates
   with map-side combine) gives, by a window over that small frame, the carry
   a piece inherits from the pieces of the same key in earlier partitions;
4. the carry is broadcast (its size is bounded by the number of range
   partitions, not by the data) and added to the rows of each partition's
   first key.

Order columns must make the order total (add a unique tie-break), as with
``row_number``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType, IntegralType

from ..plans.batch import materialize
from ..session import shared_dir

_PID, _LRN, _LSUM, _KEY = "__tm_pid", "__tm_lrn", "__tm_lsum", "__tm_key"


def _c(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


BYTES_A_PARTITION = 256 << 20


def partitions_for(df: DataFrame) -> int:
    """Range partitions for a frame: the session's shuffle partitions, or more where its
    estimated size would make them larger than ``BYTES_A_PARTITION``."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # an unknown size is reported as an absurd one (a stream's, or a product's of a join)
    return max(least, -(-size // BYTES_A_PARTITION)) if size < 1 << 56 else least


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence, value: str | None = None,
                   *, position_col: str = "position", total_col: str = "running_total",
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``position`` (1-based, within the key, in ``order``) and, when
    ``value`` is given, ``running_total`` (sum of ``value`` up to and including
    the row).  ``order`` holds column names or sort expressions (``F.desc``)."""
    spark = df.sparkSession
    key_cols = [_c(k) for k in keys]
    order_cols = [_c(o) for o in order]
    # integral and decimal values are added up as they are, other numbers as doubles
    exact = value is not None and isinstance(df.select(_c(value)).schema[0].dataType, (IntegralType, DecimalType))
    val = (_c(value) if exact else _c(value).cast("double")) if value else F.lit(0)

    # range partitioning samples its input in a separate pass: a lazily parsed
    # input is written once first, so the parse is not run twice
    src = materialize(df)
    n = num_partitions or partitions_for(src)
    path = shared_dir(spark, "tidemark", "ordered", unique=True, temporary=True)
    (src.repartitionByRange(n, *key_cols, *order_cols)
       .withColumn(_PID, F.spark_partition_id())
       .write.mode("overwrite").parquet(path))
    ranged = spark.read.parquet(path).withColumn(_KEY, F.struct(*key_cols))
    piece = Window.partitionBy(_PID, *key_cols).orderBy(*order_cols)
    local = (ranged.withColumn(_LRN, F.row_number().over(piece))
                   .withColumn(_LSUM, F.sum(val).over(
                       piece.rowsBetween(Window.unboundedPreceding, Window.currentRow))))

    # one row per range partition, from hash aggregates of the written rows
    # (no sort): count and sum per (partition, key), then per partition its
    # first and last key and the last key's count and sum
    per_key = ranged.groupBy(_PID, _KEY).agg(F.count(F.lit(1)).alias("n"), F.sum(val).alias("s"))
    summary = per_key.groupBy(_PID).agg(
        F.min(_KEY).alias("first_key"),
        F.max(_KEY).alias("last_key"),
        F.max_by(F.struct("n", "s"), F.col(_KEY)).alias("tail"))
    by_pid = Window.orderBy(_PID)
    runs = (summary
            .withColumn("run", F.sum(F.when(
                F.lag("last_key").over(by_pid).eqNullSafe(F.col("last_key")), 0).otherwise(1))
                .over(by_pid.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("run_n", F.sum("tail.n").over(
                Window.partitionBy("run").orderBy(_PID)
                      .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("run_s", F.sum("tail.s").over(
                Window.partitionBy("run").orderBy(_PID)
                      .rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    carry = (runs.select(
        _PID, "first_key",
        F.lag("last_key").over(by_pid).alias("prev_last_key"),
        F.lag("run_n").over(by_pid).alias("carry_n"),
        F.lag("run_s").over(by_pid).alias("carry_s"))
        .where(F.col("prev_last_key").eqNullSafe(F.col("first_key")))
        .select(_PID, F.col("first_key").alias("carry_key"), "carry_n", "carry_s"))

    joined = local.join(F.broadcast(carry), on=_PID, how="left")
    inherits = F.col(_KEY).eqNullSafe(F.col("carry_key"))
    out = joined.withColumn(position_col, F.col(_LRN) + F.when(inherits, F.col("carry_n")).otherwise(0))
    if value:
        # like a window sum: null until the key has seen a non-null value
        carried = F.when(inherits, F.col("carry_s"))
        out = out.withColumn(total_col, F.when(
            F.col(_LSUM).isNull() & carried.isNull(), F.lit(None))
            .otherwise(F.coalesce(F.col(_LSUM), F.lit(0)) + F.coalesce(carried, F.lit(0))))
    return out.drop(_PID, _LRN, _LSUM, _KEY, "carry_key", "carry_n", "carry_s")
