"""Current-state table: the latest row of every key, kept up to date by a change stream.

Copy-on-write over hash buckets.  A key lives in one bucket; a bucket's files hold
the winning change of each of its keys.  Merging a batch

1. reduces it to one change per key (``max_by`` on the order columns, combined
   before the shuffle, so a hot key costs one row per task);
2. reads only the buckets that the batch touches, brings each bucket together once,
   lets the later change of each key win, and writes those buckets into a fresh folder;
3. commits a new version: a small file that says which folder holds each bucket.

Buckets without a change keep their files; readers of an older version are not
disturbed; a batch that dies before its commit leaves only unreferenced files.

The later change is the one with the greater order columns (for example
``ts_ms, offset``; nulls come first).  Equal ones are told apart by their content, so
the table does not depend on arrival order: batches may come late, out of order or
twice.  For the same reason a delete stays as a row that readers do not see.  A truncate hides every row
whose order is not greater than its own, also rows that arrive later.  Changes
without an operation (malformed records) have no key and are left out; a null key is
a key like any other.

One writer per table (a stream's checkpoint gives that); a version is never written
twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.changes import OP_DELETE
from ..spec import OP_COLUMN

DEFAULT_BUCKETS = 64
OP_TRUNCATE = "t"
_BUCKET = "tidemark_bucket"


class Folder:
    """The table's folder through Spark's own file systems (any store they reach)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, sub: str) -> list[str]:
        at = self._at(sub)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a new file whole, or not at all."""
        if self._fs.exists(self._at(name)):
            raise FileExistsError(f"{self.path}/{name}: another writer was here")
        draft = self._at(f"_draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self._fs.mkdirs(self._at(name).getParent())
        if not self._fs.rename(draft, self._at(name)):
            raise FileExistsError(f"{self.path}/{name}: could not commit")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


@dataclass(frozen=True)
class Version:
    """What one commit says: the folder of each bucket that holds rows."""

    number: int
    keys: tuple[str, ...]
    order: tuple[str, ...]
    buckets: int
    schema: str                                          # of the stored changes, as JSON
    folders: Mapping[str, str] = field(default_factory=dict)   # bucket -> folder under data/
    truncated: tuple | None = None                       # order of the last truncate
    applied: Mapping[str, int] = field(default_factory=dict)   # query id -> last batch

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def _name(number: int) -> str:
    return f"versions/{number:020d}.json"


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The last committed version, or None where nothing was merged yet."""
    folder = Folder(spark, path)
    names = [n for n in folder.names("versions") if n.endswith(".json")]
    if not names:
        return None
    held = json.loads(folder.read(f"versions/{names[-1]}"))
    held["keys"], held["order"] = tuple(held["keys"]), tuple(held["order"])
    held["truncated"] = None if held["truncated"] is None else tuple(held["truncated"])
    return Version(**held)


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _order(order: Sequence[str]) -> Column:
    return F.struct(*[_col(c).alias(f"o{i}") for i, c in enumerate(order)])


def _bound(values: Sequence, schema: StructType, order: Sequence[str]) -> Column:
    return F.struct(*[F.lit(v).cast(schema[c].dataType).alias(f"o{i}") for i, (v, c) in enumerate(zip(values, order))])


def latest(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One change per key: the greatest order, then the content."""
    cols = [_col(c) for c in changes.columns]
    rank = F.struct(_order(order), F.xxhash64(*cols))
    return (changes.groupBy(*[_col(k) for k in keys])
            .agg(F.max_by(F.struct(*cols), rank).alias("row")).select("row.*"))


def _stored(spark: SparkSession, path: str, v: Version, buckets: Sequence[str] | None = None) -> DataFrame | None:
    """Stored changes of the given buckets (all by default), with those a truncate hides."""
    held = [v.folders[b] for b in (v.folders if buckets is None else buckets) if b in v.folders]
    if not held:
        return None
    return spark.read.schema(v.struct).parquet(*[f"{path.rstrip('/')}/data/{f}" for f in held])


def _visible(rows: DataFrame, v: Version) -> DataFrame:
    if v.truncated is None:
        return rows
    return rows.filter(_order(v.order) > _bound(v.truncated, v.struct, v.order))


def read_current(spark: SparkSession, path: str, version: Version | None = None) -> DataFrame:
    """The table's rows: no deleted ones, none before a truncate."""
    v = version or current_version(spark, path)
    if v is None:
        raise ValueError(f"{path}: nothing was merged here yet")
    rows = _stored(spark, path, v)
    if rows is None:
        return spark.createDataFrame([], v.struct)
    return _visible(rows, v).filter(F.col(OP_COLUMN) != OP_DELETE)


def merge_changes(changes: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], *,
                  buckets: int = DEFAULT_BUCKETS, query_id: str = "", batch_id: int | None = None) -> Version:
    """Merge one bounded frame of parsed changes (with ``op``) and commit.

    ``query_id`` and ``batch_id``, when given, are recorded with the version, and a
    batch that is handed over again is not merged again (it would change nothing).
    The number of buckets is fixed by the first merge.
    """
    spark = changes.sparkSession
    missing = [c for c in (*keys, *order, OP_COLUMN) if c not in changes.columns]
    if missing or not keys or not order:
        raise ValueError(f"a merge needs keys and order columns of the batch; not there: {missing}")
    v = current_version(spark, path)
    if v is None:
        v = Version(-1, tuple(keys), tuple(order), int(buckets), changes.schema.json())
    if (v.keys, v.order) != (tuple(keys), tuple(order)):
        raise ValueError(f"{path} is kept by {v.keys} in the order of {v.order}")
    if batch_id is not None and v.applied.get(query_id, -1) >= batch_id:
        return v
    if v.struct.simpleString() != changes.schema.simpleString():
        raise ValueError(f"{path} holds {v.struct.simpleString()}, the batch {changes.schema.simpleString()}")
    changes = changes.select(*[_col(c) for c in v.struct.names])

    op = F.col(OP_COLUMN)
    hidden = changes.filter(op == OP_TRUNCATE).agg(F.max(_order(order)).alias("at")).first()["at"]
    if hidden is not None:
        known = v.truncated
        at = tuple(hidden)
        later = known is None or spark.range(1).select(
            _bound(at, v.struct, order) > _bound(known, v.struct, order)).first()[0]
        if later:
            v = replace(v, truncated=at)
    bucket = F.pmod(F.xxhash64(*[_col(k) for k in keys]), F.lit(v.buckets)).cast("int")
    rows = _visible(changes.filter(op.isNotNull() & (op != OP_TRUNCATE)), v)
    # at most as many numbers as the table has buckets
    touched = sorted(r[0] for r in rows.select(bucket.alias("b")).distinct().collect())
    folders = dict(v.folders)
    if touched:
        rows = latest(rows, keys, order).withColumn(_BUCKET, bucket)
        held = _stored(spark, path, v, [str(b) for b in touched])
        if held is not None:
            rows = rows.unionByName(_visible(held, v).withColumn(_BUCKET, bucket))
        commit = f"{v.number + 1:020d}-{uuid.uuid4().hex}"
        # one exchange, by bucket: the rows of a key then lie together, and a bucket has one writer
        (latest(rows.repartition(_BUCKET), [_BUCKET, *keys], order)
         .write.partitionBy(_BUCKET).parquet(f"{path.rstrip('/')}/data/{commit}"))
        written = {n.split("=")[1] for n in Folder(spark, path).names(f"data/{commit}") if "=" in n}
        for b in touched:
            folders.pop(str(b), None)
            if str(b) in written:
                folders[str(b)] = f"{commit}/{_BUCKET}={b}"
    applied = {**v.applied, **({query_id: int(batch_id)} if batch_id is not None else {})}
    done = replace(v, number=v.number + 1, folders=folders, applied=applied)
    Folder(spark, path).put(_name(done.number), json.dumps(done.__dict__, default=str))
    return done


def expire(spark: SparkSession, path: str, *, keep: int = 5) -> list[str]:
    """Remove versions but the last ``keep`` and the data folders that none of those
    names (commits that never finished, too: run it between batches)."""
    folder = Folder(spark, path)
    names = [n for n in folder.names("versions") if n.endswith(".json")]
    old, kept = names[:-keep], names[-keep:]
    used = {f.split("/")[0] for n in kept for f in json.loads(folder.read(f"versions/{n}"))["folders"].values()}
    gone = [d for d in folder.names("data") if d not in used]
    for n in old:
        folder.remove(f"versions/{n}")
    for d in gone:
        folder.remove(f"data/{d}")
    return gone
