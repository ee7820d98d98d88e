"""What a job does to one bounded frame (one micro-batch).

1. ``run_sql``: register the batch under the job's view name and run the job's
   SQL in the *batch's own session* (a streaming micro-batch lives in a cloned
   session; a view made there is invisible to the outer one).  Blank SQL is a
   pass-through.  The SQL sees only this batch: aggregates, sorts, limits and
   distincts are per batch, with no state carried across batches.
2. ``select_columns``: keep the listed columns that exist, in list order.

Joins with static tables, aggregates, windows, set operations and subqueries
all come from the SQL; Catalyst and AQE pick the physical strategy.
"""

from __future__ import annotations

import re
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir
from ..spec import JobSpec


def materialize(batch: DataFrame) -> DataFrame:
    """Write a lazily parsed bounded frame once to the shared folder and read it back,
    so that several readers share one parse; each then reads only the columns it
    needs.  A persisted micro-batch already holds parsed rows and is returned as it
    is.  The files go when the application ends; lost executors only retry their
    write tasks.
    """
    if batch.isStreaming or batch.storageLevel.useMemory or batch.storageLevel.useDisk:
        return batch
    path = shared_dir(batch.sparkSession, "tidemark", "staged", unique=True, temporary=True)
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def view_reads(spark: SparkSession, sql: str, view: str) -> int:
    """How often the SQL reads the view, from its analysed plan (a common table
    expression that is used again counts again)."""
    plan = spark.sql(f"EXPLAIN EXTENDED {sql}").first()[0]
    analysed = plan.split("== Analyzed Logical Plan ==")[-1].split("== Optimized Logical Plan ==")[0]
    reads = len(re.findall(rf"SubqueryAlias `?{re.escape(view)}`?(?![\w`])", analysed, re.I))
    uses, made = analysed.count("CTERelationRef"), analysed.count("CTERelationDef")
    return reads + max(0, uses - made)


def run_sql(batch: DataFrame, sql: str | None, view: str, *, stage: bool = False) -> DataFrame:
    """Run the SQL over the batch.  ``stage``: when the SQL reads the view more than
    once, the batch is written first, with every column; read once, nothing is
    written (later filters stay above the parse in any case)."""
    if not sql or not sql.strip():
        return batch
    spark = batch.sparkSession
    batch.createOrReplaceTempView(view)
    if stage and view_reads(spark, sql, view) > 1:
        materialize(batch).createOrReplaceTempView(view)
    return spark.sql(sql)


def select_columns(df: DataFrame, columns: Iterable[str] | None) -> DataFrame:
    """Keep listed columns in list order; unknown names are ignored (case-sensitive);
    when none of them exists, or the list is empty, keep every column."""
    wanted = [c for c in (columns or []) if c in df.columns]
    if not wanted:
        return df
    return df.select(*[f"`{c}`" for c in wanted])


def apply_batch(batch: DataFrame, spec: JobSpec, batch_id: int | None = None, *,
                materialize_input: bool = True) -> DataFrame:
    view = spec.output.temp_view or spec.name or f"_tmp_batch_{batch_id}"
    held = batch.isStreaming or batch.storageLevel.useMemory or batch.storageLevel.useDisk
    out = run_sql(batch, spec.output.sql, view, stage=materialize_input and not held)
    return select_columns(out, spec.output.columns)
