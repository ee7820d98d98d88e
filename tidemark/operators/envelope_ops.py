"""Operators on raw change records that keep the record intact.

* ``lift_metadata``: add ``op``, ``ts_ms``, ``source_table`` and ``source_db``
  next to every input column.
* ``filter_by_operation``: keep records whose ``op`` is in a list.

Both read the record with one native parse; the filter runs before any row
image is cast, so the typed parse only sees the records that survive.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions.changes import read_envelope, record_op

_ENV = "__tm_env"
_META = "op STRING, ts_ms STRING, source STRUCT<`table`: STRING, db: STRING>"


def lift_metadata(df: DataFrame, *, value_col: str = "value") -> DataFrame:
    """Add ``op STRING, ts_ms BIGINT, source_table STRING, source_db STRING``.

    Input columns are kept; one that already has one of these names is
    replaced in place (as ``withColumn`` would).  A record that is not a JSON
    object, or lacks a part, gives nulls for the parts it lacks; a ``source``
    that is not an object gives null table and db.  A quoted ``ts_ms`` holding
    digits still reads as a number.  Only these parts are read out of the record; the
    images are passed over.
    """
    e = F.col(_ENV)
    meta = {
        "op": e.getField("op"),
        "ts_ms": e.getField("ts_ms").try_cast("bigint"),
        "source_table": e.getField("source").getField("table"),
        "source_db": e.getField("source").getField("db"),
    }
    cols = [F.col(f"`{c}`") for c in df.columns]
    out = [meta[c].alias(c) if c in meta else F.col(f"`{c}`") for c in df.columns]
    out += [expr.alias(name) for name, expr in meta.items() if name not in df.columns]
    value = F.col("`" + value_col.replace("`", "``") + "`")
    return df.select(*cols, read_envelope(value, _META).alias(_ENV)).select(*out)


def filter_by_operation(df: DataFrame, operations: Iterable[str] | None, *,
                        value_col: str = "value") -> DataFrame:
    """Keep records whose ``op`` is one of ``operations``; the schema is unchanged.

    An empty or missing list returns the input unchanged.  Records with no
    ``op``, a null ``op`` or invalid JSON never match.
    """
    ops = [str(o) for o in (operations or [])]
    if not ops:
        return df
    return df.filter(record_op(F.col("`" + value_col.replace("`", "``") + "`")).isin(*ops))
