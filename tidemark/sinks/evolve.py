"""Schema evolution of a path sink: one table whose columns grow over a job's life.

The table's schema is kept beside its files, a new version whenever it changes.  A
batch is taken in by column name:

* a column that the table has not seen is added; older rows read as null;
* a column that the batch lacks stays, and is null in the new rows;
* a wider type (``int`` to ``bigint`` or ``double``, ``float`` to ``double``) becomes
  the table's type; the files already written are read with it, not rewritten;
* anything else is refused before a row is written: a narrower type would turn large
  values into nulls without a word, and other changes have no one meaning.

Names are matched as Spark matches them, without regard to case; the table's spelling
stays.  One writer per table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, ByteType, StructField,
                               StructType)

from ..spec import OutputSpec
from .current import Folder
from .table import write_batch

# The widenings that Spark's Parquet reader applies to older files.
WIDER: dict[type, tuple[type, ...]] = {
    ByteType: (ShortType, IntegerType, LongType, DoubleType),
    ShortType: (IntegerType, LongType, DoubleType),
    IntegerType: (LongType, DoubleType),
    FloatType: (DoubleType,),
}
_LOG = "_tidemark_schema"      # the underscore keeps it out of Spark's file listing


class SchemaChangeError(ValueError):
    """A batch whose columns the table cannot take in."""


def widens(old: DataType, new: DataType) -> bool:
    return type(new) in WIDER.get(type(old), ())


def evolved(table: StructType, batch: StructType) -> StructType:
    """The table's schema after the batch; raises where it cannot take it in."""
    known = {f.name.lower(): f for f in table.fields}
    given = {f.name.lower(): f for f in batch.fields}
    if len(given) != len(batch.fields):
        raise SchemaChangeError("the batch has two columns of one name")
    refused = [f"{f.name}: {f.dataType.simpleString()} to {given[n].dataType.simpleString()}" for n, f in known.items()
               if n in given and given[n].dataType != f.dataType and not widens(f.dataType, given[n].dataType)]
    if refused:
        raise SchemaChangeError("a column can be added or widened, not " + "; ".join(refused))
    out = [StructField(f.name, given[n].dataType if n in given else f.dataType, True) for n, f in known.items()]
    out += [StructField(f.name, f.dataType, True) for n, f in given.items() if n not in known]
    return StructType(out)


def table_schema(spark: SparkSession, path: str) -> StructType | None:
    """The recorded schema; None for a folder that was never written this way."""
    folder = Folder(spark, path)
    names = [n for n in folder.names(_LOG) if n.endswith(".json")]
    return StructType.fromJson(json.loads(folder.read(f"{_LOG}/{names[-1]}"))) if names else None


def write_evolving(df: DataFrame, out: OutputSpec, *, batch_id: int | None = None, query_id: str = "") -> StructType:
    """Append one bounded frame to ``out.path``; returns the table's schema after it."""
    spark = df.sparkSession
    if not out.path or out.write_mode.lower() != "append" or out.format != "parquet":
        raise ValueError("schemas evolve in parquet tables at a path that are appended to")
    known = table_schema(spark, out.path)
    now = evolved(known or StructType([]), df.schema)
    if known is None or now != known:
        # recorded first: a reader meets columns that no file has yet, never files it cannot read
        number = len([n for n in Folder(spark, out.path).names(_LOG) if n.endswith(".json")])
        Folder(spark, out.path).put(f"{_LOG}/{number:020d}.json", now.json())
    spelled = {f.name.lower(): f.name for f in now.fields}
    named = df.select(*[F.col(f"`{c}`").alias(spelled[c.lower()]) for c in df.columns])
    write_batch(named, out, batch_id=batch_id, query_id=query_id)
    return now


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """The whole table with its present columns."""
    schema = table_schema(spark, path)
    if schema is None:
        raise ValueError(f"{path}: no recorded schema")
    return spark.read.schema(schema).parquet(path)
