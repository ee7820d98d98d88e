"""The logical plan of a job: source -> parse -> (per batch) SQL -> columns.

``job_frame`` builds the streaming frame up to the parse and the event-time
operators, whose state goes across batches; the per-batch part
is ``plans.batch.apply_batch``.  ``backfill_frame`` is the same plan over the
bounded source, for re-loading history with the same semantics (each call is
one batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.parse import parse_changes
from ..sources.change_stream import read_change_batch, read_change_stream
from ..spec import JobSpec
from ..operators.event_time import apply_event_time
from .batch import apply_batch

METRICS_NAME = "cdc_rows"


def parsed(raw: DataFrame, spec: JobSpec) -> DataFrame:
    return parse_changes(raw, spec.schema, keep=spec.source.keep_columns,
                         operations=spec.operations, envelope=spec.envelope)


def with_metrics(df: DataFrame, name: str = METRICS_NAME) -> DataFrame:
    """Row count and rows per op, reported with the query's progress (and on
    batch frames through an Observation); no extra job, no action."""
    op = F.col("op")
    return df.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(op == "c").alias("creates"),
        F.count_if(op == "u").alias("updates"),
        F.count_if(op == "d").alias("deletes"),
        F.count_if(op.isNull()).alias("malformed"),
    )


def job_frame(spark: SparkSession, spec: JobSpec, metrics: bool = True) -> DataFrame:
    df = parsed(read_change_stream(spark, spec.source), spec)
    df = with_metrics(df) if metrics else df
    return apply_event_time(df, spec.event_time) if spec.event_time and spec.event_time.stateful else df


def backfill_frame(spark: SparkSession, spec: JobSpec) -> DataFrame:
    return apply_batch(parsed(read_change_batch(spark, spec.source), spec), spec)
