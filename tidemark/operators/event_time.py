"""Event-time operators of a change stream: windows, sessions, deduplication and
stream-stream interval joins, with a watermark.

All keep state across micro-batches, in the query's checkpoint, so a restarted job
goes on where it stopped; the watermark (the greatest event time seen, less the
allowed delay) closes windows, ends sessions and lets go of state.  In append mode a
window or session is emitted once, when the watermark has passed its end.  Rows
behind the watermark are dropped by Spark; ``streaming.late`` keeps them.

State is partitioned by key, and aggregates are combined before the shuffle, so a
hot key costs one row per task and window.  A join's state cannot be combined:
``salts`` deals the rows of a hot key into that many parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType, TimestampType

from ..spec import EventTimeSpec
from .interval_state import BUCKETS, can_keep_by_bucket, join_by_bucket

_SALT = "tidemark_salt"


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def with_watermark(df: DataFrame, column: str, delay: str) -> DataFrame:
    """``df`` with a watermark on ``column``; a whole number is read as epoch
    milliseconds (as ``ts_ms`` is).  Rows without an event time cannot be placed in
    time and are left out here."""
    kind = df.schema[column].dataType
    at = _col(column)
    if isinstance(kind, IntegralType):
        df = df.withColumn(column, F.timestamp_millis(at.cast("bigint")))
    elif not isinstance(kind, TimestampType):
        raise ValueError(f"event time {column!r} is a {kind.simpleString()}: a timestamp or epoch milliseconds is needed")
    return df.filter(at.isNotNull()).withWatermark(column, delay)


def _aggregated(df: DataFrame, span: Column, keys: Sequence[str], aggregates: Mapping[str, str]) -> DataFrame:
    clash = {"window_start", "window_end"} & {*keys, *aggregates}
    if clash or not aggregates:
        raise ValueError(f"window aggregates need names of their own: {sorted(clash)}")
    out = df.groupBy(span.alias("tidemark_span"), *[_col(k) for k in keys]).agg(
        *[F.expr(sql).alias(name) for name, sql in aggregates.items()])
    return out.select(F.col("tidemark_span.start").alias("window_start"), F.col("tidemark_span.end").alias("window_end"),
                      *[_col(k) for k in keys], *[_col(a) for a in aggregates])


def event_windows(df: DataFrame, column: str, size: str, *, slide: str | None = None, keys: Sequence[str] = (),
                  aggregates: Mapping[str, str]) -> DataFrame:
    """Tumbling windows (sliding ones when ``slide`` is given) of a frame with a
    watermark: ``window_start, window_end``, the keys, and each SQL aggregate."""
    return _aggregated(df, F.window(_col(column), size, slide), keys, aggregates)


def sessions(df: DataFrame, column: str, gap: str, *, keys: Sequence[str], aggregates: Mapping[str, str]) -> DataFrame:
    """Sessions per key: rows less than ``gap`` apart belong together, also across
    batches; a session ends ``gap`` after its last row."""
    return _aggregated(df, F.session_window(_col(column), gap), keys, aggregates)


def dedup(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The first row of each id; a repeat within the watermark's delay of it is dropped
    whichever batch or run brings it.  State holds the ids of that time only."""
    return df.dropDuplicatesWithinWatermark(list(ids))


def interval_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], left_time: str, right_time: str,
                  lower: str, upper: str, *, how: str = "inner", salts: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Rows of two streams (each with a watermark) with equal keys whose times lie
    within ``left + lower <= right <= left + upper`` (SQL intervals without the word,
    such as ``-1 hour``).  ``how``: ``inner``, or ``left_outer``, where a left row
    without a partner is emitted once the watermarks say that none can come.

    ``on`` maps left to right columns; no column name may be on both sides.
    ``salts`` cuts each key's state into that many parts: a left row goes to one, by
    its content, and a right row to each, so no pair is lost or doubled.  The state of
    two streams is kept in ``buckets`` of keys and salts (see ``interval_state``; more salts
    than buckets are not made), numbers to which their checkpoint is bound; a join that
    does not fit it is left to Spark's own state.
    """
    if how not in ("inner", "left_outer"):
        raise ValueError(f"how must be inner or left_outer: {how!r}")
    both = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if both:
        raise ValueError(f"columns on both sides of the join: {sorted(both)}")
    pairs = list(on.items())
    if can_keep_by_bucket(left, right, pairs, left_time, right_time, lower, upper):
        return join_by_bucket(left, right, pairs, left_time, right_time, lower, upper, how, salts, buckets)
    if salts > 1:
        left = left.withColumn(_SALT, F.pmod(F.xxhash64(*[_col(c) for c in left.columns]), F.lit(salts)).cast("int"))
        right = right.withColumn(_SALT + "_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        pairs.append((_SALT, _SALT + "_r"))
    match = ((_col(right_time) >= _col(left_time) + F.expr(f"INTERVAL {lower}"))
             & (_col(right_time) <= _col(left_time) + F.expr(f"INTERVAL {upper}")))
    for a, b in pairs:
        match = match & (_col(a) == _col(b))
    out = left.join(right, match, how)
    return out.drop(_SALT, _SALT + "_r")


def apply_event_time(df: DataFrame, spec: EventTimeSpec | None) -> DataFrame:
    """What a job's ``event_time`` says, on its parsed changes."""
    if spec is None:
        return df
    out = with_watermark(df, spec.column, spec.delay)
    if spec.dedup:
        out = dedup(out, spec.dedup)
    if spec.window and spec.session_gap:
        raise ValueError("a job has either windows or sessions")
    if spec.window:
        return event_windows(out, spec.column, spec.window, slide=spec.slide, keys=spec.keys, aggregates=spec.aggregates)
    if spec.session_gap:
        return sessions(out, spec.column, spec.session_gap, keys=spec.keys, aggregates=spec.aggregates)
    return out
