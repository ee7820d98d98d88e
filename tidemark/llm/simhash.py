"""SimHash near-duplicates by tiled exact comparison.

Fingerprint: 64 majority bits over the XXH64 hashes of a text's word shingles.
Two fingerprints link at ``radius`` differing bits or fewer; a document's
component is all it reaches over links.

Comparison is exact, by numpy exclusive-or and bit counts over tiles of
fingerprints sorted by population count: a tile pair whose counts lie further
apart than the radius holds no link and is skipped.  Equal fingerprints are
compared once.  A tile only ever holds fingerprints that can link: the 64 bits
are cut into ``radius + 1`` blocks, and two fingerprints within the radius agree
in one block at least, so tiles are laid inside each block value.  A block value
with very many fingerprints is cut by the same rule again on the remaining bits,
and what is still large is dealt out as tile pairs over many tasks.

A task hands on a spanning forest of the links it found, never all pairs, and
the components of all forests are joined by alternating star contractions with a
checkpoint per round.  No fingerprint or link is collected to the driver.

Rows: a null, empty or wordless text has fingerprint zero, linked like any other;
fewer words than a shingle are one shingle; repeated rows share a component; a
null id never names a component unless nothing else does; an empty table gives
no rows.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import Renamed, cut, ship, text_of, with_columns_from, written

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
TILE = 512          # side of one numpy comparison
GROUP = 8192        # fingerprints one task compares among themselves

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CHUNK = 1 << 16    # hashes whose bits are unpacked at a time


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each ``size``-word shingle (repeats included), unsigned."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxh64_intdigest(line, SEED)], np.uint64)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends)]
    return np.fromiter((xxh64_intdigest(line[s:e], SEED) for s, e in zip(starts, ends[size - 1:])),
                       np.uint64, len(words) - size + 1)


def majority(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[at:at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(df: DataFrame, text_col: str = "text", fingerprint_col: str = "fingerprint",
                size: int = SHINGLE) -> DataFrame:
    """``df`` with each text's fingerprint as a (signed) 64-bit integer."""
    def make():
        def f(texts):
            got = np.array([majority(shingle_hashes(t or "", size)) for t in texts], np.uint64)
            return (pa.array(got.view(np.int64), pa.int64()),)
        return f

    return with_columns_from(df, text_col, make, [StructField(fingerprint_col, LongType())])


def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    return [[int(b) for b in part] for part in np.array_split(bits, parts)]


def _mask(bits) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def masks(radius: int) -> tuple[list[int], list[list[int]]]:
    """Of each block, its mask; and those of it with each block of the other bits."""
    one, two = [], []
    for block in _blocks(list(range(BITS)), radius + 1):
        one.append(_mask(block))
        rest = [b for b in range(BITS) if b not in block]
        two.append([_mask(block + more) for more in _blocks(rest, radius + 1)])
    return one, two


def forest(prints: np.ndarray, radius: int, right: np.ndarray | None = None) -> np.ndarray:
    """For each fingerprint the index of one it is connected to (itself if none),
    a star for each component.  With ``right`` (booleans) only links between
    the two sides are made."""
    m = len(prints)
    root = np.arange(m)
    ones = np.bitwise_count(prints).astype(np.int64)
    order = np.argsort(ones, kind="stable")
    f, ones = prints[order], ones[order]
    side = None if right is None else right[order]
    for a in range(0, m, TILE):
        top = ones[min(a + TILE, m) - 1]
        for b in range(a, m, TILE):
            if ones[b] - top > radius:
                break                       # this tile and all after it are too far
            near = np.bitwise_count(f[a:a + TILE, None] ^ f[None, b:b + TILE]) <= radius
            i, j = np.nonzero(near)
            i, j = i + a, j + b
            ok = i < j
            if side is not None:
                ok &= side[i] != side[j]
            x, y = root[i[ok]], root[j[ok]]
            ok = x != y
            if not ok.any():
                continue
            pairs = np.unique(np.minimum(x[ok], y[ok]) * m + np.maximum(x[ok], y[ok]))
            up: dict[int, int] = {}

            def find(v):
                while up.get(v, v) != v:
                    up[v] = up.get(up[v], up[v])
                    v = up[v]
                return v

            for code in pairs.tolist():
                p, q = find(code // m), find(code % m)
                if p != q:
                    up[max(p, q)] = min(p, q)
            table = np.arange(m)
            for v in list(up):
                table[v] = find(v)
            root = table[root]
    out = np.empty(m, np.int64)
    out[order] = order[root]
    return out


def _compare(keyed: DataFrame, radius: int) -> DataFrame:
    """Links (a forest per key) of rows ``mask, value, task, side, fp``: side 0 is
    compared within the key, sides 1 and 2 with each other."""
    ship(keyed.sparkSession)
    rows = (keyed.repartition("mask", "value", "task")
            .sortWithinPartitions("mask", "value", "task").select("mask", "value", "task", "side", "fp"))
    schema = StructType([StructField("u", LongType()), StructField("v", LongType())])

    def links(prints, side):
        if len(prints) < 2:
            return None
        prints = prints.view(np.uint64)
        root = forest(prints, radius, None if not side.any() else side == 2)
        own = np.flatnonzero(root != np.arange(len(root)))
        return (prints[own].view(np.int64), prints[root[own]].view(np.int64)) if len(own) else None

    def run(batches):
        held: list[np.ndarray] = []       # the key that the last batch ended in
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                    for c in ("mask", "value", "task", "side", "fp")]
            rows = np.stack(cols)
            if held:
                rows = np.concatenate([*held, rows], axis=1)
            n = rows.shape[1]
            if not n:
                continue
            ends = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(0)) + 1
            last = ends[-1] if len(ends) else 0
            found = []
            starts = np.concatenate([[0], ends])[:-1] if len(ends) else []
            for s, e in zip(starts, ends):
                if e - s > 1 and (got := links(rows[4, s:e].copy(), rows[3, s:e])):
                    found.append(got)
            held = [rows[:, last:].copy()]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x[k] for x in found])) for k in (0, 1)], names=["u", "v"])
        if held and (got := links(held[0][4].copy(), held[0][3])):
            yield pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1])], names=["u", "v"])

    return rows.mapInArrow(run, schema)


def _large(keyed: DataFrame, group: int) -> DataFrame:
    """Keys with more rows than one task should compare, and how many parts to make."""
    return (keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group)
            .select("mask", "value", F.ceil(F.col("n") / group).cast("long").alias("parts")))


def link(prints: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints (column ``fp``) that connect
    exactly what lies within the radius."""
    one, two = masks(radius)
    near = F.col("fp")

    def key(number, mask):
        return F.struct(F.lit(number).cast("long").alias("mask"),
                        near.bitwiseAND(F.lit(mask)).alias("value"))

    keyed = prints.select("fp", F.explode(F.array(*[key(i, m) for i, m in enumerate(one)])).alias("k")) \
        .select("fp", "k.*")
    hot = cut(_large(keyed, group))
    plain = [F.lit(0).cast("long").alias("task"), F.lit(0).cast("long").alias("side")]
    if hot.isEmpty():
        return _compare(keyed.select("mask", "value", *plain, "fp"), radius)
    found = _compare(keyed.join(hot, ["mask", "value"], "left_anti").select("mask", "value", *plain, "fp"),
                     radius)
    # Large keys: the same cut again on the other bits.
    finer = keyed.join(hot, ["mask", "value"], "left_semi")
    more = None
    for i, ms in enumerate(two):
        cols = F.array(*[key((i + 1) * 100 + j, m) for j, m in enumerate(ms)])
        one_block = finer.filter(F.col("mask") == i).select("fp", F.explode(cols).alias("k")).select("fp", "k.*")
        more = one_block if more is None else more.unionAll(one_block)
    more = written(more, "simhash-finer")
    still = cut(_large(more, group))
    found = found.unionAll(_compare(more.join(still, ["mask", "value"], "left_anti")
                                    .select("mask", "value", *plain, "fp"), radius))
    # Still large: tiles by (population count, part); a task for each pair of tiles
    # whose counts lie within the radius.
    step = radius + 1
    level = F.floor(F.bit_count("fp") / step).cast("long")
    tiles = (more.join(still, ["mask", "value"])
             .withColumn("level", level).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts"))))
    other = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda p: F.array(
        *[F.struct((F.col("level") + d).alias("level"), p.alias("part")) for d in (-1, 0, 1)]))
    dealt = tiles.withColumn("o", F.explode(F.flatten(other)))
    me = F.struct("level", "part")
    first, second = F.least(me, F.col("o")), F.greatest(me, F.col("o"))
    dealt = dealt.select(
        "mask", "value", "fp",
        F.xxhash64(first["level"], first["part"], second["level"], second["part"]).alias("task"),
        F.when(me == F.col("o"), 0).when(me == first, 1).otherwise(2).cast("long").alias("side"))
    return found.unionAll(_compare(dealt, radius))


def _stars(edges: DataFrame) -> DataFrame:
    """``u, v`` for every node ``u`` but the least of its component, ``v`` that least:
    alternating large and small stars until nothing changes."""
    edges = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == seen or not state[0]:
            return edges
        seen = tuple(state)
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                 .unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        edges = cut(small)


def components(rows: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """``fp, component`` for each fingerprint of ``rows`` (``id, fp``): the
    smallest id over all documents its fingerprint reaches."""
    each = cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    star = _stars(link(each.select("fp"), radius, group))
    rooted = each.join(star.withColumnRenamed("u", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("v", "fp").alias("root"))
    linked = rooted.join(star.select(F.col("v").alias("root")).distinct(), "root", "left_semi") \
        .groupBy("root").agg(F.min("least").alias("over"))
    return rooted.join(linked, "root", "left").select("fp", F.coalesce("over", "least").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = SHINGLE, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """``doc_id, fingerprint`` (signed 64-bit) and ``component_id`` for each row."""
    rows = fingerprint(docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")),
                       "text", "fp", size)
    rows = written(rows.select("id", "fp"), "simhash")
    named = components(rows, radius, group)
    return rows.join(named, "fp").select(F.col("id").alias("doc_id"), F.col("fp").alias("fingerprint"),
                                         F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (of
    repeated rows one)."""
    own = Renamed(docs)
    marked = written(fingerprint(own.frame.withColumn("row", F.monotonically_increasing_id()), own.of(text_col),
                                 "fp", size), "simhash-docs")
    rows = marked.select(F.col(own.of(id_col)).alias("id"), "fp", "row")
    named = components(rows.select(F.col("row").alias("id"), "fp"), radius)
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))
    kept = (rows.groupBy("fp").agg(F.min(first).alias("first")).join(named, "fp")     # copies go before the join
            .groupBy("component").agg(F.min("first").alias("first")).select("first.row"))
    return own.back(marked.join(kept, "row", "left_semi"))
