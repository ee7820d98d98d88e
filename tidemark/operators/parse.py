"""Change records -> typed rows (one output row per input row).

The row image is chosen by the operation: ``before`` for a delete, ``after``
for every other code (create, update, truncate, snapshot read, ...).

A record is *well formed* when its top level is an object, its ``op`` is
absent or a string, and the chosen image is null, absent or an object.  A
malformed record is kept, with every output column null (no drop, no dead
letter).  A well-formed record without ``op`` gets ``op = ''``; one whose
image is null (e.g. a truncate) gets null fields and its ``op``.

Plan shape: one Project parses the record (a VARIANT) and reads ``op``; the
next casts the chosen image to the declared fields in one struct cast (the
image is navigated in place, never copied out) and computes the well-formed
flag; a Generate (``inline`` of a one-row array) emits that struct; the last
Project lays the fields out, so a field that nobody reads is not converted.  All
of it sits in one whole-stage-codegen span with no Python in the plan.

Why the Generate: Catalyst pushes a filter (or an inferred not-null of a join
key, or a semi join) below a Project by inlining the projected expression,
so a later ``filter(op == 'c')`` would parse every record again inside the
Filter, once per reference.  A filter on a generator's output cannot move
below the generator: the parse runs exactly once per record whatever comes
after it.  Filters on ``keep`` columns still reach the source.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.changes import (
    OP_DELETE, any_rewritten, image_struct_type, is_json_text, parse_record, text_fields, texts_as_written, typed_from_struct,
)
from ..spec import OP_COLUMN, DeclaredSchema

_V, _OPV, _OK, _OP, _ROW, _RAW = "__tm_v", "__tm_opv", "__tm_ok", "__tm_op", "__tm_row", "__tm_raw"
_ENV, _TEXT = "__tm_env", "__tm_text"

_EMPTY_STRUCT = "struct<>"


def _keep(df: DataFrame, keep: Iterable[str]) -> list[Column]:
    names = list(keep or ())
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"columns to keep not in input: {missing}")
    return [_quoted(c) for c in names]


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _is_object(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, _EMPTY_STRUCT).isNotNull()


def _null_or_absent(v: Column, path: str) -> Column:
    # a JSON null or a missing key reads as SQL null; anything else has text
    return F.try_variant_get(v, path, "string").isNull()


def _emit(row: Column, keep_row: Column | None = None) -> Column:
    """One output row from a struct; none when ``keep_row`` is not true
    (``inline`` of a null array emits nothing)."""
    rows = F.array(row)
    if keep_row is not None:
        rows = F.when(keep_row, rows)
    return F.inline(rows)


def parse_changes(df: DataFrame, schema: Any, *, value_col: str = "value",
                  keep: Iterable[str] = (), image: str = "auto",
                  operations: Iterable[str] | None = None,
                  columns: Iterable[str] | None = None,
                  envelope: Mapping[str, str] | None = None) -> DataFrame:
    """Parse change records in ``value_col`` into the declared fields plus ``op``.

    ``keep`` carries input columns (e.g. a Kafka ``key``, ``partition``,
    ``offset``) in front of the declared fields.  ``image`` is ``auto``
    (delete -> before, else after), ``before`` or ``after``.  ``operations``,
    when not empty, keeps only records whose op is in the list (decided on the
    parsed op, before any image is cast; malformed records never match).
    ``columns``, when given, narrows the image cast to these declared fields.
    ``envelope`` adds values that stand beside the images, after ``op``: a dotted
    path to a type, e.g. ``{"ts_ms": "bigint", "source.pos": "bigint"}``, each named
    by its last part; absent or ill-typed values and malformed records give null.
    Works on batch and streaming frames alike.
    """
    declared = DeclaredSchema.coerce(schema)
    declared.check_parse_target()
    if columns is not None:
        wanted_names = set(columns)
        unknown = wanted_names - set(declared.names)
        if unknown:
            raise ValueError(f"columns not declared: {sorted(unknown)}")
        declared = DeclaredSchema.coerce([f for f in declared.fields if f.name in wanted_names])
    if image not in ("auto", "before", "after"):
        raise ValueError(f"image must be auto, before or after: {image!r}")
    env = envelope_names(envelope)
    parsed_names = [*declared.names, OP_COLUMN, *env]
    if len(set(parsed_names)) != len(parsed_names):
        raise ValueError(f"envelope values would clash with other columns: {sorted(env)}")
    clash = set(keep or ()) & set(parsed_names)
    if clash:
        raise ValueError(f"kept columns would clash with parsed ones: {sorted(clash)}")
    names = _keep(df, keep)
    st = image_struct_type(declared)

    texts = bool(text_fields(declared))
    text = [_quoted(value_col).cast("string").alias(_TEXT)] if texts else []
    step1 = df.select(*names, parse_record(_quoted(value_col)).alias(_V), *text)
    text = [F.col(_TEXT)] if texts else []
    v = F.col(_V)
    opv = F.try_variant_get(v, "$['op']", "variant")
    op_is_text = is_json_text(opv)
    op_text = F.when(op_is_text, F.try_variant_get(opv, "$", "string"))
    beside = [F.struct(*[F.try_variant_get(v, _path(p), t).alias(n) for n, (p, t) in env.items()]).alias(_ENV)] if env else []
    step2 = step1.select(*names, v, opv.alias(_OPV), op_text.alias(_OP), *text, *beside)
    beside = [F.col(_ENV)] if env else []

    v, opv, op = F.col(_V), F.col(_OPV), F.col(_OP)
    is_delete = F.coalesce(op == F.lit(OP_DELETE), F.lit(False))

    def chosen(of: Callable[[str], Column]) -> Column:
        if image == "auto":
            return F.when(is_delete, of("before")).otherwise(of("after"))
        return of(image)

    row = chosen(lambda part: F.try_variant_get(v, f"$['{part}']", st))
    # the image cast gets a Project of its own, so it is evaluated once per
    # record (not again inside the short-circuit of the well-formed check)
    step3 = step2.select(*names, v, opv, op, row.alias(_ROW), *text, *beside)

    v, opv, op, rowc = F.col(_V), F.col(_OPV), F.col(_OP), F.col(_ROW)
    img_absent = chosen(lambda part: _null_or_absent(v, f"$['{part}']"))
    ok = (_is_object(v, "$")
          & (opv.isNull() | op.isNotNull())
          & (rowc.isNotNull() | img_absent))
    # a text field that holds a number, an object or an array: its text is read from the record
    raws = [F.when(any_rewritten(F.col(_ROW), declared),
                   chosen(lambda part: texts_as_written(F.col(_TEXT), declared, part))).alias(_RAW)] if texts else []
    step3 = step3.select(*names, ok.alias(_OK), op, rowc, *raws, *beside)

    okc, rowc = F.col(_OK), F.col(_ROW)
    held = [F.when(okc, rowc).alias(_ROW)] + [F.when(okc, F.col(_RAW)).alias(_RAW) for _ in raws]
    held += [F.when(okc, F.col(_ENV)).alias(_ENV) for _ in beside]
    op_out = F.when(okc, F.coalesce(F.col(_OP), F.lit(""))).alias(OP_COLUMN)
    ops = [str(o) for o in (operations or [])]
    wanted = okc & F.coalesce(F.col(_OP), F.lit("")).isin(*ops) if ops else None
    rows = step3.select(*names, _emit(F.struct(*held, op_out), wanted))
    rawc = F.col(_RAW) if raws else None
    return rows.select(*names, *[typed_from_struct(F.col(_ROW), f, rawc).alias(f.name) for f in declared.fields],
                       F.col(OP_COLUMN), *[F.col(_ENV).getField(n).alias(n) for n in env])


def envelope_names(envelope: Mapping[str, str] | None) -> dict[str, tuple[str, str]]:
    """Column name -> (dotted path, type) of the values that stand beside the images."""
    return {p.rsplit(".", 1)[-1]: (p, t) for p, t in (envelope or {}).items()}


def _path(dotted: str) -> str:
    return "$" + "".join(f"['{part}']" for part in dotted.split("."))


def parse_after_only(df: DataFrame, schema: Any, *, value_col: str = "value",
                     keep: Iterable[str] = ()) -> DataFrame:
    """Relational form of the after-image reader: one typed row for each record
    whose ``after`` is an object, whatever the op; other records are dropped."""
    declared = DeclaredSchema.coerce(schema)
    names = _keep(df, keep)
    st = image_struct_type(declared)
    texts = bool(text_fields(declared))
    v = F.col(_V)
    step1 = (df.select(*names, _quoted(value_col).cast("string").alias(_TEXT), parse_record(_quoted(value_col)).alias(_V))
             .select(*names, _TEXT, F.try_variant_get(v, "$['after']", st).alias(_ROW)))
    raws = [F.when(any_rewritten(F.col(_ROW), declared),
                   texts_as_written(F.col(_TEXT), declared, "after")).alias(_RAW)] if texts else []
    step1 = step1.select(*names, _ROW, *raws)
    rowc, rawc = F.col(_ROW), F.col(_RAW) if raws else None
    typed = F.struct(*[typed_from_struct(rowc, f, rawc).alias(f.name) for f in declared.fields])
    return step1.select(*names, _emit(typed, rowc.isNotNull()))
