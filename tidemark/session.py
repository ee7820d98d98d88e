"""Session settings a job needs, and the shared folder for job state.

Nothing here creates a session: the caller owns it (deployment settings such
as object-store credentials, metastore and catalog jars belong to whoever
launches Spark).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .functions.changes import DUPLICATE_KEYS
from .spec import JobSpec

# Duplicate keys in a record: the last one wins (as in Python's json module),
# instead of the whole record being treated as invalid.
VARIANT_DUPLICATE_KEYS = DUPLICATE_KEYS

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
HEAP_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
# A state of the size of its input lies on disk once and as the last two batches left it:
# compacted before it is checkpointed, old versions deleted and the local copy let go as
# soon as a task is done with it, not minutes later by a background thread.
ONE_COPY = {
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.ratioExtraSpaceAllowedInCheckpoint": "0",
}
# A query's shuffle files go when it ends, not when the driver next collects garbage.
SHUFFLE_CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def prepare_session(spark: SparkSession, spec: JobSpec | None = None) -> None:
    """Runtime SQL conf a job relies on; streaming conf from the job spec."""
    spark.conf.set(VARIANT_DUPLICATE_KEYS, "true")
    if spec is None:
        return
    s = spec.spark
    if s.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(s.shuffle_partitions))
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", str(s.min_batches_to_retain))
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval",
                   str(s.no_data_progress_event_interval))
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled",
                   "true" if s.no_data_micro_batches_enabled else "false")
    if spec.event_time is not None and spec.event_time.stateful:
        use_rocksdb(spark)
    for k, v in (s.extra_conf or {}).items():
        spark.conf.set(k, str(v))


def use_rocksdb(spark: SparkSession) -> None:
    """State on the executors' disks instead of their heaps, unless the session already
    names a state store: keys held between batches may outgrow memory.  A batch's state is
    checkpointed as the store's own files, so that a restart fetches them; a log of changes
    would be applied anew, all of it, where no maintenance ran before the job ended.  The
    four parts of a join's state share a store, and no disk is set aside ahead of use (a
    job has a store per state partition and operator, most of them small)."""
    if spark.conf.get(STATE_STORE, None) in (None, HEAP_STATE_STORE):
        spark.conf.set(STATE_STORE, ROCKSDB_STATE_STORE)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "false")
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
        spark.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]):
    """The session's settings for what is started inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def uncounted_state(spark: SparkSession):
    """Queries started inside do not count their state's rows (``numRowsTotal``): the count
    costs a lookup for every row that is put or removed."""
    return settings(spark, {STATE_ROWS: "false"})


def checkpoint_setting(spark: SparkSession) -> str | None:
    """The folder named by the ``spark.checkpoint.dir`` setting: the same in every
    application, unlike ``getCheckpointDir()``, which ends in a fresh id."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else None


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder for scratch tables.

    The ``spark.checkpoint.dir`` setting, else the application's checkpoint
    folder; only when both are unset (local tests) is a folder of our own made
    and set.  Stream checkpoints never use the last two: see ``job_checkpoint``.
    """
    root = checkpoint_setting(spark)
    if root:
        return root
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-scratch-"))
    return sc.getCheckpointDir().rstrip("/")


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False, temporary: bool = False) -> str:
    """A folder under the shared root (made by whoever writes to it); ``unique``
    appends a fresh id, ``temporary`` has it removed when the application ends."""
    segs = [p.strip("/") for p in parts if p]
    if unique:
        segs.append(uuid.uuid4().hex)
    path = "/".join([shared_root(spark), *segs])
    if temporary:
        remove_at_end(spark, path)
    return path


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have the path's own file system delete it when the driver ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
