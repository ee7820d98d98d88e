"""Helpers the training-data operators share: the shared folder, written
stages, and per-row Python columns that keep a batch's memory bounded."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..session import remove_at_end

# Text bytes one Python step holds at a time; one longer text is a step alone.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 1024

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    tasks import it wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor sees.
    Only where that is unset (local tests) is a temporary one made and set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
        if not root:
            root = tempfile.mkdtemp(prefix="tidemark-shared-")
            spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage,
    survives lost executors, and fixes what later steps see.  The files go when the
    application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidemark/llm/{name}-{uuid.uuid4().hex}"
    remove_at_end(spark, path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint of a small table (ids and labels) in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def text_of(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def as_one(names: list[str]) -> Column:
    """The named columns as one struct (never an empty one), under which no name of
    theirs can meet a helper column's."""
    mark = "_" + max(names, key=len, default="")
    return F.struct(F.lit(1).alias(mark), *[F.col(f"`{c}`") for c in names])


class Renamed:
    """A caller's frame under column names of our own, so that none of its names can meet
    a helper column's; ``back`` gives the names back."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.own = [f"tidemark_own_{i}" for i in range(len(self.names))]
        self.frame = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(self.names, self.own)])

    def of(self, name: str) -> str:
        return self.own[self.names.index(name)]

    def back(self, made: DataFrame, added: tuple[str, ...] = (), without: tuple[str, ...] = ()) -> DataFrame:
        """``made`` with the caller's columns, but those that an added one replaces (case
        aside) or that are left out, then the added ones."""
        new = {a.lower() for a in added}
        return made.select(*[F.col(o).alias(c) for c, o in zip(self.names, self.own)
                             if c.lower() not in new and c not in without], *[F.col(f"`{a}`") for a in added])


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES,
           max_rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch, of about ``max_bytes`` of ``column`` each."""
    n = batch.num_rows
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i in range(n):
        if i > start and (held + sizes[i] > max_bytes or i - start >= max_rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += sizes[i]
    if n > start:
        yield batch.slice(start, n - start)


def with_columns_from(df: DataFrame, text: str, make: Callable[[], Callable],
                      fields: list[StructField], drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``fields`` computed from its ``text`` column by Python.

    ``make()`` runs once per task and returns ``f(values) -> [pa.Array, ...]``
    (one per field).  A field whose name clashes with a column of ``df``
    replaces it.  No shuffle; at most ``SLICE_BYTES`` of text per step.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    new = {f.name.lower() for f in fields} | {d.lower() for d in drop}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    out = StructType(kept + fields)
    arrow = to_arrow_schema(StructType(fields))
    names = [f.name for f in kept]

    def run(batches):
        f = make()
        for batch in batches:
            for part in slices(batch, text):
                made = [a if isinstance(a, pa.Array) else pa.array(a, arrow.field(i).type)
                        for i, a in enumerate(f(part.column(text).to_pylist()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + made, names=names + arrow.names)

    return df.mapInArrow(run, out)
