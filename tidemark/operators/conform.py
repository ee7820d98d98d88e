"""Bring any frame to a declared schema.

``conform(df, declared)`` selects the declared columns in declared order, adds
a typed null for each declared column the input lacks, and casts every column
by the declared-type rules (the same rules the change-record parse uses, so a
frame conformed here equals the same rows parsed from change records).
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.changes import TRUTHY_WORDS, safe_cast
from ..spec import DeclaredField, DeclaredSchema


def _conformed(col: Column, source: T.DataType, field: DeclaredField) -> Column:
    """The declared-type rules, with the exact shortcuts a known source type
    allows: same type passes through, text reads directly as text, boolean,
    date or timestamp; everything else goes through the shared rules."""
    target = field.spark_type
    if source == target:
        return col
    if isinstance(source, T.StringType):
        t = field.sql_type
        if t == "string":
            return col
        if t == "boolean":
            return F.lower(col).isin(*TRUTHY_WORDS)
        if t in ("date", "timestamp"):
            return col.try_cast(t)
    if field.sql_type in ("string", "boolean") and not isinstance(
            source, (T.StructType, T.ArrayType, T.MapType, T.VariantType, T.BinaryType)):
        text = col.cast("string")
        return F.lower(text).isin(*TRUTHY_WORDS) if field.sql_type == "boolean" else text
    return safe_cast(col, field.type)


def conform(df: DataFrame, schema: Any, *, case_sensitive: bool = True) -> DataFrame:
    declared = DeclaredSchema.coerce(schema)
    by_name = {c if case_sensitive else c.lower(): c for c in df.columns}
    out = []
    for f in declared.fields:
        src = by_name.get(f.name if case_sensitive else f.name.lower())
        if src is None:
            out.append(F.lit(None).cast(f.spark_type).alias(f.name))
        else:
            out.append(_conformed(F.col(f"`{src}`"), df.schema[src].dataType, f).alias(f.name))
    return df.select(*out)
