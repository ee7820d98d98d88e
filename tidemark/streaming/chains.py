"""Broken change chains: a change whose before image is not what its key's last change left.

A stateful operator (``applyInPandasWithState`` on the RocksDB store).  Changes of a key
may arrive in any order within the watermark's delay, so each waits in the state, and an
event-time timeout wakes it when the watermark has passed the change: then the due changes
are walked in order (``ts_ms``, position), each before image is compared with the after
image that the last one left, and that image stays as the key's state.  Batches and
restarts make no difference.

The first change seen of a key has nothing to be compared with; a change without a
before image (a create or a snapshot read) starts the chain anew; after a delete the key
is empty.  Images are compared as JSON with sorted keys, by a 64-bit hash: state holds no
image.  This operator needs Python workers (Spark's stateful processors are not
expressions).  Keys are dealt by hash into buckets that are walked together, since a call
and its state cost far more than a change: a batch reads and writes the buckets that it
touches whole, and a bucket's keys and waiting changes are in one task at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.changes import after_image, before_image
from ..operators.envelope_ops import lift_metadata
from ..operators.event_time import with_watermark

BUCKETS = 4096
# JSON: the waiting changes (key, time, position, operation, hashes), and each key's last after hash
_STATE = "pending string, known string"
BROKEN = "key string, ts_ms bigint, pos bigint, op string"


def _walker():
    """The task's function; it is made here so that workers need not import this package."""
    def walk(_, frames, state):
        import json

        import pandas as pd

        limit = state.getCurrentWatermarkMs()
        pending, known_text = state.get if state.exists else ("[]", "{}")
        changes = json.loads(pending)
        for frame in frames:
            columns = [frame[c].tolist() for c in ("key", "ts_ms", "pos", "op", "before_hash", "after_hash")]
            columns[2] = [None if p is None else int(p) for p in columns[2]]
            changes += zip(*columns)
        due = [c for c in changes if c[1] <= limit]
        rest = [c for c in changes if c[1] > limit]
        broken = []
        if due:
            due.sort(key=lambda c: (c[1], c[2] is not None, c[2] or 0))
            known = json.loads(known_text)
            for key, at, pos, op, before, after in due:
                if before is not None and key in known and before != known[key]:
                    broken.append((key, at, pos, op))
                known[key] = after
            known_text = json.dumps(known, separators=(",", ":"))
        state.update((json.dumps(rest, separators=(",", ":")), known_text))
        if rest:    # fires when the watermark is past the timeout, so at the earliest change's own time
            state.setTimeoutTimestamp(max(min(c[1] for c in rest) - 1, limit, 1))
        if broken:
            out = pd.DataFrame(broken, columns=["key", "ts_ms", "pos", "op"])
            out["pos"] = out["pos"].astype("Int64")
            yield out

    return walk


def chain_input(records: DataFrame, key: str, *, value_col: str = "value", position: str = "source.pos") -> DataFrame:
    """What the operator needs of raw change records: ``key`` (the image's field, as
    text), time, position, operation and hashed images."""
    v = F.col(f"`{value_col}`")
    source, place = position.rsplit(".", 1)
    lifted = lift_metadata(records, value_col=value_col)
    at = F.try_variant_get(F.try_parse_json(v), f"$['{source}']['{place}']", "bigint")
    before, after = before_image(v), after_image(v)
    field = f"$['{key}']"
    of = lambda image: F.try_variant_get(F.try_parse_json(image), field, "string")
    return lifted.select(F.coalesce(of(after), of(before)).alias("key"), "ts_ms",
                         at.cast("string").alias("pos"), "op",
                         F.when(before.isNotNull(), F.xxhash64(before)).cast("string").alias("before_hash"),
                         F.when(after.isNotNull(), F.xxhash64(after)).cast("string").alias("after_hash"))


def broken_chains(records: DataFrame, key: str, delay: str, *, value_col: str = "value",
                  position: str = "source.pos", buckets: int = BUCKETS) -> DataFrame:
    """Streaming rows ``key, ts_ms, pos, op`` of the changes that do not fit their key's
    last image.  Records without a key or a time are not looked at.  Choose ``buckets`` so
    that a bucket's keys fit a task; a checkpoint is bound to the number it began with."""
    rows = chain_input(records, key, value_col=value_col, position=position)
    rows = rows.filter(F.col("key").isNotNull() & F.col("ts_ms").isNotNull())
    timed = with_watermark(rows.withColumn("at", F.timestamp_millis("ts_ms")), "at", delay)
    timed = timed.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return timed.groupBy("bucket").applyInPandasWithState(
        _walker(), outputStructType=BROKEN, stateStructType=_STATE, outputMode="append", timeoutConf="EventTimeTimeout")
