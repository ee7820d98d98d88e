"""Late rows: those behind the watermark go to a sink of their own, and are counted.

A micro-batch's watermark is the greatest event time of the batches before it, less
the allowed delay, kept per batch in the checkpoint folder, so that a replayed batch is
cut where it was cut the first time.  (Spark's stateful operators let go of state by
the same watermark; where batches follow each other at once, they still take in rows
that the batch before would have taken.)
On-time rows go on to the job's SQL and sink; the two parts add up to the batch.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

from ..sinks.current import Folder
from ..spec import EventTimeSpec

_KEPT = 10      # batches whose watermark stays on file


class LateRows:
    """Splits each micro-batch of one query."""

    def __init__(self, spec: EventTimeSpec, checkpoint: str):
        self.spec, self.checkpoint = spec, checkpoint.rstrip("/")
        self.counts: dict[int, tuple[int, int]] = {}      # batch -> rows on time, late (the last few)

    def _before(self, folder: Folder, batch_id: int) -> int | None:
        """Greatest event time (epoch microseconds) of the batches before this one."""
        names = [n for n in folder.names("watermark") if n.endswith(".json") and int(n[:-5]) < batch_id]
        return json.loads(folder.read(f"watermark/{names[-1]}"))["latest"] if names else None

    def split(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """On-time and late rows of a batch; rows without an event time are on time."""
        spark, column = batch.sparkSession, f"`{self.spec.column}`"
        folder = Folder(spark, f"{self.checkpoint}/tidemark-late")
        at = F.col(column)
        micros = at.cast("bigint") * 1000 if dict(batch.dtypes)[self.spec.column] != "timestamp" else F.unix_micros(at)
        before = self._before(folder, batch_id)
        late = F.lit(False)
        if before is not None:
            limit = F.timestamp_micros(F.lit(before)) - F.expr(f"INTERVAL {self.spec.delay}")
            late = F.coalesce(F.timestamp_micros(micros) < limit, F.lit(False))
        # one row back: the counts and the greatest time of the batch
        n_late, n, greatest = batch.agg(F.count_if(late), F.count(F.lit(1)), F.max(micros)).first()
        self.counts[batch_id] = (n - n_late, n_late)
        for old in sorted(self.counts)[:-_KEPT]:
            del self.counts[old]
        name = f"watermark/{batch_id:020d}.json"
        if name.split("/")[1] not in folder.names("watermark"):
            latest = max((x for x in (before, greatest) if x is not None), default=None)
            folder.put(name, json.dumps({"latest": latest, "on_time": n - n_late, "late": n_late}))
            for old in [x for x in folder.names("watermark") if x.endswith(".json")][:-_KEPT]:
                folder.remove(f"watermark/{old}")
        return batch.filter(~late), batch.filter(late)
