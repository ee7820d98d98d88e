"""Winnowing fingerprints.

Every ``k``-gram of code points gets a rolling hash; of each window of ``w``
consecutive hashes the least is kept, the rightmost of equals.  Any passage of
``w + k - 1`` code points that two texts share leaves a common hash in both
(the match guarantee), and kept hashes carry their positions, so a shared hash
says where the passages lie.

A fingerprint is written ``hash@position`` (eight hex digits, decimal), comma
joined in text order.  Likeness is the share of distinct hashes two fingerprints
have in common.

Rows: a null or empty text has an empty fingerprint (alike only to another empty
one); a text shorter than ``k`` is one gram; rows of one id follow each other in the
order of their compressed bytes (any order will do, but the same each time); a null id
comes last; an empty table gives no rows.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (BinaryType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from .common import ship, slices, text_of, with_columns_from

GRAM = 8
WINDOW = 17         # with GRAM: every shared passage of 24 code points is found, at any text length
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def _roll(codes: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all grams, by doubling: a gram of 2n from two of n."""
    level = (codes + np.uint64(1)) * _MIX
    level ^= level >> _HALF
    step, power = 1, _BASE
    out, have = None, 0
    while True:
        if size & step:
            if out is None:
                out, have = level, step
            else:                       # the part so far, then this one behind it
                n = len(codes) - have - step + 1
                out = out[:n] * power + level[have:have + n]
                have += step
        if have == size:
            return out
        level = level[:-step] * power + level[step:]
        power, step = power * power, step * 2


def gram_hashes(text: str, k: int = GRAM) -> np.ndarray:
    """32-bit hashes of the ``k``-grams of ``text``; of a shorter text, its own."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(codes):
        return codes
    with np.errstate(over="ignore"):
        h = _roll(codes, min(k, len(codes)))
        if len(codes) < k:
            h = h + np.uint64(len(codes))
        h = (h ^ (h >> _HALF)) * _MIX
        return h >> _HALF


def winnowed(text: str, k: int = GRAM, w: int = WINDOW) -> np.ndarray:
    """Kept grams in text order: hash in the high, inverted position in the low 32 bits."""
    h = gram_hashes(text, k)
    n = len(h)
    if not n:
        return h
    v = (h << _HALF) | (_LOW - np.arange(n, dtype=np.uint64))   # least: rightmost of equal hashes
    w = min(w, n)
    step = 1
    while step * 2 <= w:
        v = np.minimum(v[:-step], v[step:])
        step *= 2
    if step < w:
        v = np.minimum(v[:n - w + 1], v[w - step:])
    return v[np.concatenate([[True], v[1:] != v[:-1]])]


def shown(kept: np.ndarray) -> str:
    hashes = (kept >> _HALF).tolist()
    places = (_LOW - (kept & _LOW)).tolist()
    return ",".join([f"{h:08x}@{p}" for h, p in zip(hashes, places)])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    x, y = np.unique(a >> _HALF), np.unique(b >> _HALF)
    if not len(x) and not len(y):
        return 1.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def fingerprint(df: DataFrame, text_col: str = "text", fingerprint_col: str = "fingerprint",
                k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """``df`` with the winnowing fingerprint of each text."""
    def make():
        return lambda texts: (pa.array([shown(winnowed(t or "", k, w)) for t in texts], pa.string()),)
    return with_columns_from(df, text_col, make, [StructField(fingerprint_col, StringType())])


def edited(text: str, follower: str) -> str:
    """``text`` with its last third replaced by as much of its follower's start."""
    n = len(text)
    m = n // 3
    return text[:n - m] + follower[:m]


class _Ranges:
    """Ranges of descending ids; each range's first id, and the range before it."""

    def __init__(self, cuts: list):
        self.up = sorted(set(cuts))

    def of(self, i) -> int:
        """0 holds the largest ids; null comes after all."""
        return len(self.up) + 1 if i is None else len(self.up) - bisect.bisect_left(self.up, i)


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             ranges: int | None = None) -> DataFrame:
    """Rows ``doc_id, z`` (the text, compressed) in ranges of descending id, sorted,
    each range followed by a copy of the row that comes next (``extra`` = 1; after
    the last range, the first row).  Only ids are looked at beforehand; of them
    the driver holds two per range.  One shuffle, of compressed texts.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * parts
    points = [(i + 1) / ranges for i in range(ranges - 1)] or [0.5]
    got = rows.select(F.percentile_approx("doc_id", points, max(10_000, 4 * ranges)).alias("c")).first()
    of = _Ranges(list(got.c or []))

    def number(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([of.of(i) for i in ids], pa.int32()),
                                              batch.column("doc_id")], names=["part", "doc_id"])

    numbered = rows.select("doc_id").mapInArrow(
        number, StructType([StructField("part", IntegerType()), StructField("doc_id", LongType())]))
    heads = sorted((r.part, r.head) for r in numbered.groupBy("part").agg(F.max("doc_id").alias("head")).collect())
    before = {p: (heads[i - 1][0], head) for i, (p, head) in enumerate(heads)}
    schema = StructType([StructField("part", IntegerType()), StructField("extra", IntegerType()),
                         StructField("doc_id", LongType()), StructField("z", BinaryType())])

    def spread(batches):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for piece in slices(batch, "text"):
                out = [], [], [], []
                for i, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    z, p = squeeze(text.encode()), of.of(i)
                    earlier, head = before[p]
                    for row in [(p, 0, i, z)] + [(earlier, 1, i, z)] * (i == head):
                        for column, value in zip(out, row):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                    names=schema.names)

    return (rows.mapInArrow(spread, schema).repartition(parts, "part")
            .sortWithinPartitions("part", "extra", F.col("doc_id").desc_nulls_last(), "z"))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = GRAM,
                      w: int = WINDOW, ranges: int | None = None) -> DataFrame:
    """For each document (descending id) its fingerprint, its edited text (last third
    taken from the next document) with fingerprint, and the likeness of its
    fingerprint to both: ``doc_id, n_chars, fingerprint, edited_text,
    edited_fingerprint, near_edited, near_next``."""
    schema = StructType([
        StructField("doc_id", LongType()), StructField("n_chars", LongType()),
        StructField("fingerprint", StringType()), StructField("edited_text", StringType()),
        StructField("edited_fingerprint", StringType()), StructField("near_edited", DoubleType()),
        StructField("near_next", DoubleType())])

    def run(batches):
        import zstandard

        plain = zstandard.ZstdDecompressor().decompress
        held = None                        # the row that waits for its follower
        for batch in batches:
            for piece in slices(batch, "z", 1 << 20, 512):
                out = {name: [] for name in schema.names}
                for part, extra, i, z in zip(*(piece.column(c).to_pylist() for c in ("part", "extra", "doc_id", "z"))):
                    if extra and (held is None or held[0] != part):
                        continue           # a further copy with an equal id
                    text = plain(z).decode()
                    kept = winnowed(text, k, w)
                    if held is not None:
                        _, j, prior, had = held
                        new = edited(prior, text)
                        changed = winnowed(new, k, w)
                        for name, value in zip(schema.names, (
                                j, len(prior), shown(had), new, shown(changed), likeness(had, changed),
                                likeness(had, kept))):
                            out[name].append(value)
                    held = None if extra else (part, i, text, kept)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], {"doc_id": pa.int64(), "n_chars": pa.int64(), "near_edited": pa.float64(),
                                            "near_next": pa.float64()}.get(f.name, pa.string()))
                     for f in schema.fields], names=schema.names)

    return followed(docs, id_col, text_col, ranges).mapInArrow(run, schema)
