"""Column functions over change records.

A change record is JSON text with ``before``, ``after``, ``source``, ``op`` and
``ts_ms``.  Every function here is a native Catalyst expression: the record is
parsed once into a VARIANT and the parts are read from it, so the work stays in
whole-stage codegen and no row crosses into Python.

Cast rules (declared type -> how a JSON value is read):

* int / bigint / double / float: numeric value, numeric text with spaces or a
  boolean; a fraction is truncated for the integral types; text that is not a
  number, or a number out of range, gives null.
* boolean: true when the value's text, lower-cased, is one of the truthy words;
  never null unless the value is null.
* date / timestamp: the value's text through ``try_cast``.
* string, struct and anything else: text; objects and arrays as JSON text.
"""

from __future__ import annotations

import functools
from typing import Any

from pyspark.sql import Column, SparkSession, functions as F

from ..spec import DeclaredSchema, spark_type_name

# The texts a boolean field reads as true (case-insensitive).
TRUTHY_WORDS = ("true", "1", "yes")

# Fixed value: the operation code whose row is the image before the change.
OP_DELETE = "d"

# Session setting of the variant parser: of an object's equal keys the last wins.
DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"

# Texts of any length (the reader's own limit is 20 million characters).
_TEXT_OPTIONS = {"maxStringLen": "2147483647"}
# Bytes from which on a record may hold such a text.
_LONG_RECORD = 20_000_000
_NUMERIC = ("int", "bigint", "double", "float")


def _col(c: Any) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_record(value: Any) -> Column:
    """Record text (string or binary) -> VARIANT; null when it is not valid JSON.
    The setting for equal keys is made here, so no caller has to know of it.  A
    record long enough to hold a text beyond the plain parser's limit goes through
    the reader that has no such limit."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.conf.get(DUPLICATE_KEYS, "false") != "true":
        spark.conf.set(DUPLICATE_KEYS, "true")
    text = _col(value).cast("string")
    return F.when(F.octet_length(text) >= _LONG_RECORD, F.from_json(text, "variant", _TEXT_OPTIONS)) \
            .otherwise(F.try_parse_json(text))


def is_json_null(v: Column) -> Column:
    return F.is_variant_null(v)


def is_json_text(v: Column) -> Column:
    """True when the variant holds a JSON string."""
    return F.schema_of_variant(v) == F.lit("STRING")


def variant_text(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "string")


def typed_value(v: Column, declared_type: Any, path: str = "$") -> Column:
    """Read the value at ``path`` of a variant by a declared type (cast rules above)."""
    t = spark_type_name(declared_type)
    if t in ("int", "bigint", "double", "float"):
        return F.try_variant_get(v, path, t)
    text = variant_text(v, path)
    if t == "boolean":
        return F.lower(text).isin(*TRUTHY_WORDS)
    if t in ("date", "timestamp"):
        return text.try_cast(t)
    return text


def to_variant(c: Any) -> Column:
    """Any typed column -> VARIANT object ``{"v": value}`` (nested values as objects)."""
    return F.to_variant_object(F.struct(_col(c).alias("v")))


def safe_cast(c: Any, declared_type: Any) -> Column:
    """Cast a typed column by the declared-type rules; failures become null."""
    t = spark_type_name(declared_type)
    if t not in _NUMERIC + ("date", "timestamp"):     # text as it is written, numbers unchanged
        text = F.from_json(F.to_json(F.struct(_col(c).alias("v"))), "struct<v:string>", _TEXT_OPTIONS).getField("v")
        return F.lower(text).isin(*TRUTHY_WORDS) if t == "boolean" else text
    return typed_value(to_variant(c), declared_type, "$.v")


def _struct_field_type(declared_type: Any) -> str:
    t = spark_type_name(declared_type)
    return t if t in _NUMERIC else "variant"


def image_struct_type(schema: Any) -> str:
    """DDL of the struct a row image is cast to: numeric fields as their type, every
    other field as it was parsed (its text is taken by ``typed_from_struct``)."""
    declared = DeclaredSchema.coerce(schema)
    parts = ["`" + f.name.replace("`", "``") + "`:" + _struct_field_type(f.type)
             for f in declared.fields]
    return "struct<" + ",".join(parts) + ">"


def text_fields(schema: Any) -> list[Any]:
    """Declared fields that are read as text."""
    return [f for f in DeclaredSchema.coerce(schema).fields if _struct_field_type(f.type) == "variant"]


# Variant types whose text is the record's own: numbers lose their writing (``73.0``, a
# long integer), objects and arrays their order and spaces.
_AS_WRITTEN = ("STRING", "VOID", "BOOLEAN")


def any_rewritten(row: Column, schema: Any) -> Column | None:
    """True when a text field of the image holds a number, an object or an array, whose
    text has to be read from the record again; None when the schema has no text field."""
    found = [~F.coalesce(F.schema_of_variant(row.getField(f.name)), F.lit("VOID")).isin(*_AS_WRITTEN)
             for f in text_fields(schema)]
    return functools.reduce(lambda a, b: a | b, found) if found else None


def texts_as_written(value: Any, schema: Any, part: str) -> Column:
    """The image's text fields as the record writes them (a second, narrow read)."""
    row = "struct<" + ",".join("`" + f.name.replace("`", "``") + "`:string" for f in text_fields(schema)) + ">"
    return F.from_json(_col(value).cast("string"), f"struct<{part}:{row}>", _TEXT_OPTIONS).getField(part)


def typed_from_struct(row: Column, field: Any, raw: Column | None = None) -> Column:
    """One declared field out of an image cast with ``image_struct_type``; ``raw`` is
    ``texts_as_written`` where ``any_rewritten``, else null."""
    value = row.getField(field.name)
    t = field.sql_type
    if t in _NUMERIC:
        return value
    value = variant_text(value)
    if raw is not None:
        value = F.coalesce(raw.getField(field.name), value)
    if t == "boolean":
        return F.lower(value).isin(*TRUTHY_WORDS)
    if t in ("date", "timestamp"):
        return value.try_cast(t)
    return value


# Strict JSON, texts of any length.
_RECORD_OPTIONS = {**_TEXT_OPTIONS, "allowSingleQuotes": "false"}


def read_envelope(value: Any, schema: str) -> Column:
    """Parts of the record beside its images, by a DDL schema: one narrow read that
    passes over everything else; null fields when the record is invalid."""
    return F.from_json(_col(value).cast("string"), schema, _RECORD_OPTIONS)


def record_op(value: Any) -> Column:
    """The record's ``op`` as text; null when absent, null or the record is invalid."""
    return read_envelope(value, "op STRING").getField("op")


def _image(value: Any, part: str, schema: Any = None) -> Column:
    v = parse_record(value)
    path = f"$['{part}']"
    if schema is None:
        img = F.try_variant_get(v, path, "variant")
        return F.when(~is_json_null(img), F.to_json(img))
    declared = DeclaredSchema.coerce(schema)
    row = F.try_variant_get(v, path, image_struct_type(declared))
    if not text_fields(declared):
        return row  # the struct cast already is the typed image (null if not an object)

    # bind each read once (a lambda variable), so the record is not parsed again for every field
    def typed(r: Column) -> Column:
        return F.when(r.getField("row").isNotNull(), F.struct(*[
            typed_from_struct(r.getField("row"), f, r.getField("raw")).alias(f.name) for f in declared.fields]))
    both = F.transform(F.array(F.struct(row.alias("row"))), lambda r: F.struct(r.getField("row").alias("row"), F.when(
        any_rewritten(r.getField("row"), declared), texts_as_written(value, declared, part)).alias("raw")))
    return F.transform(both, typed).getItem(0)


def before_image(value: Any, schema: Any = None) -> Column:
    """Row before the change: JSON text, or a typed struct when a schema is given
    (null when the image is absent, null or not an object)."""
    return _image(value, "before", schema)


def after_image(value: Any, schema: Any = None) -> Column:
    """Row after the change: JSON text, or a typed struct when a schema is given."""
    return _image(value, "after", schema)


def source_metadata(value: Any) -> Column:
    """The record's ``source`` object as ``map<string,string>``; null if not an object."""
    return F.try_variant_get(parse_record(value), "$['source']", "map<string,string>")
