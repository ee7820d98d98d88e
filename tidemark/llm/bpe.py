"""Byte-level BPE with a hierarchical-bitmap rank queue.

A pre-token's bytes form a linked list.  Every adjacent pair whose joined bytes
have a rank waits in the bucket of that rank, by position.  Three levels of
64-bit words mark the buckets in use, and find-first-set on them gives the least
rank in three steps however many pairs wait, so a pre-token of n bytes costs
O(n) queue steps (a plain scan for the least rank costs O(n^2)).  A merge does
not search the queue for the pairs it destroys: their entries turn stale and are
skipped when their bucket comes up; when no pair is left but stale ones, the rest of
the queue is dropped at once.

Texts are cut by the split pattern first; the ids of short chunks between spaces
are remembered in two bounded generations per worker: what is asked for again moves
into the younger one, and a full younger one becomes the older.

Rows: null and empty texts have no ids; ids of no known token fail the decode;
an empty table gives no rows.  Added columns replace columns of the same name.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from .common import text_of, with_columns_from

CACHED_CHUNKS = 700_000     # of one generation
CACHED_PIECES = 150_000
LONGEST_CACHED = 48
MARKS = ".,;:!?"


WORD = 8                                   # bits of a rank that its word of marks covers
MASK = (1 << WORD) - 1
_MARK = [1 << i for i in range(1 << WORD)]


def rank_words(ranks: int) -> list[int]:
    """Empty marks for ranks below ``ranks``: words of 256 bits; a further word
    (``top`` in :func:`merge`) marks those of them that are not zero."""
    return [0] * ((max(ranks, 1) >> WORD) + 1)


SHIFT = 32                                 # a pair of ranks as one number


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """The rank of every two tokens that join into one."""
    out = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                out[left << SHIFT | right] = rank
    return out


def merge(piece: bytes, ranks: dict[bytes, int], marks: list[int], pairs: dict[int, int] | None = None,
          single: list[int] | None = None) -> list[int]:
    """Ids of one pre-token: always the least rank, leftmost first.  ``marks`` comes
    and goes with no bit set; ``pairs`` (:func:`pair_ranks`) and ``single`` (ranks of the
    bytes) are made of ``ranks`` where they are not given.  (The queue's steps stand in
    line: a call for each would cost more than the step.)"""
    if pairs is None or single is None:
        pairs, single = pair_ranks(ranks), [ranks.get(bytes([b]), -1) for b in range(256)]
    n = len(piece)
    get, mark = pairs.get, _MARK
    ids = [single[b] for b in piece]       # rank of the part that starts here
    after = list(range(1, n + 1))          # where it ends
    prior = list(range(-1, n))             # where the part to the left starts
    waits = [-1] * (n + 1)                 # rank of the pair that starts here
    buckets: dict[int, list[int]] = {}     # positions by rank
    top = 0                                # first level: words of marks in use
    live = 0                               # pairs that wait and are not stale
    left = ids[0]
    for i in range(n - 1):
        right = ids[i + 1]
        r = get(left << SHIFT | right)
        left = right
        if r is not None:
            live += 1
            waits[i] = r
            if r in buckets:
                buckets[r].append(i)
            else:
                buckets[r] = [i]
                a = r >> WORD
                marks[a] |= mark[r & MASK]
                top |= 1 << a
    while live:
        a = (top & -top).bit_length() - 1  # find first set: the word, then the rank in it
        word = marks[a]
        rank = (a << WORD) + (word & -word).bit_length() - 1
        word &= word - 1
        marks[a] = word
        if not word:
            top &= top - 1
        bucket = buckets.pop(rank)
        if len(bucket) > 1:
            bucket.sort()
        for at, i in enumerate(bucket):
            if waits[i] != rank:
                continue                   # stale
            j = after[i]
            k = after[j]
            live -= 1
            if waits[j] >= 0:
                live -= 1
                waits[j] = -1
            after[i] = k
            prior[k] = i
            ids[i] = rank
            sooner = False
            r = get(rank << SHIFT | ids[k]) if k < n else None
            if r is None:
                waits[i] = -1
            else:
                live += 1
                waits[i] = r
                sooner = r < rank
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    a = r >> WORD
                    marks[a] |= mark[r & MASK]
                    top |= 1 << a
            h = prior[i]
            if h >= 0:
                r = get(ids[h] << SHIFT | rank)
                if waits[h] >= 0:
                    live -= 1
                if r is None:
                    waits[h] = -1
                else:
                    live += 1
                    waits[h] = r
                    sooner = sooner or r < rank
                    if r in buckets:
                        buckets[r].append(h)
                    else:
                        buckets[r] = [h]
                        a = r >> WORD
                        marks[a] |= mark[r & MASK]
                        top |= 1 << a
            if sooner and at + 1 < len(bucket):   # what is now due sooner goes first
                buckets[rank] = bucket[at + 1:]
                marks[rank >> WORD] |= mark[rank & MASK]
                top |= 1 << (rank >> WORD)
                break
    for r in buckets:                      # stale entries only
        marks[r >> WORD] = 0
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    if -1 in out:
        raise KeyError("a byte of the text is no token")
    return out


class ByteEncoder:
    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.marks = rank_words(max(self.ranks.values()) + 1)
        self.pairs = pair_ranks(self.ranks)
        self.single = [self.ranks.get(bytes([b]), -1) for b in range(256)]
        self.split = regex.compile(pattern).findall
        # White space other than single spaces and line ends between words: no shortcut.
        self.odd = regex.compile(r"\s\s|^\s|\s\Z|[^\S \n]").search
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}   # by what follows a space; "\n..." stands for itself
        self.older: dict[str, bytes] = {}    # the generation before
        # a word of these letters alone is one match of the usual pattern, a mark after it another
        probe = ["Straße", "ñandú", "o", "Œuvre", "ǆ"]
        self.plain_words = all(self.split(f" {w}{m}") == [f" {w}", *m] for w in probe for m in ("", *MARKS))
        self.foreign = regex.compile(r"[^\x00-\u024f]").search
        self.tokens = {i: b for b, i in self.ranks.items()}

    def _ids(self, piece: str) -> bytes:
        raw = piece.encode()
        one = self.ranks.get(raw)
        ids = [one] if one is not None else merge(raw, self.ranks, self.marks, self.pairs, self.single)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _is_word(self, key: str) -> bool:
        return key.isalpha() and (key.isascii() or self.plain_words and not self.foreign(key))

    def _piece(self, piece: str) -> bytes:
        word = piece[1:]
        if piece[0] == " " and self._is_word(word):
            got = self.chunks.get(word)
            return self._chunk(word) if got is None else got
        got = self.pieces.get(piece)
        if got is None:
            got = self._ids(piece)
            if len(piece) <= LONGEST_CACHED:
                self.pieces[piece] = got
        return got

    def _chunk(self, key: str) -> bytes:
        got = self.older.get(key)
        if got is None:
            word = key[:-1]
            if self._is_word(key):                    # one match of the pattern
                got = self._ids(" " + key)
            elif key[-1] in MARKS and self.plain_words and self._is_word(word):
                got = self.chunks.get(word)           # a known word before a mark
                got = (self._chunk(word) if got is None else got) + self._piece(key[-1])
            else:
                got = b"".join(map(self._piece, self.split(key if key[0] == "\n" else " " + key)))
        if len(key) <= LONGEST_CACHED:
            self.chunks[key] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if len(self.chunks) > CACHED_CHUNKS:
            self.older, self.chunks = self.chunks, {}
        if len(self.pieces) > CACHED_PIECES:
            self.pieces = {}
        if self.odd(text):
            return b"".join(map(self._piece, self.split(text)))
        # The pattern never joins a word to what stands before its space or line end.
        get, chunk = self.chunks.get, self._chunk
        first, *rest = text.replace("\n", " \n").split(" ")
        out = list(map(get, rest))
        if None in out:
            for k, key in enumerate(rest):
                if out[k] is None:
                    got = get(key)
                    out[k] = chunk(key) if got is None else got
        return b"".join(map(self._piece, self.split(first))) + b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def byte_encoder(path: str, pattern: str) -> ByteEncoder:
    return ByteEncoder(path, pattern)


def encode(df: DataFrame, ranks: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
           count_col: str = "n_tokens") -> DataFrame:
    """``df`` with each text's ids (binary, little-endian unsigned 32-bit) and
    their number; the text column stays unless an added column has its name."""
    def make():
        enc = byte_encoder(ranks, pattern)

        def f(texts):
            ids = [enc.encode(t) for t in texts]
            return pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())
        return f

    return with_columns_from(df.withColumn(text_col, text_of(text_col)), text_col, make,
                             [StructField(ids_col, BinaryType()), StructField(count_col, LongType())])


def decode(df: DataFrame, ranks: str, pattern: str, ids_col: str = "ids",
           bytes_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its ids stand for."""
    def make():
        enc = byte_encoder(ranks, pattern)
        return lambda rows: (pa.array([enc.decode(x) for x in rows], pa.binary()),)

    rows = df.withColumn(ids_col, F.coalesce(F.col(ids_col), F.lit(b"")))
    return with_columns_from(rows, ids_col, make, [StructField(bytes_col, BinaryType())])


def round_trip(df: DataFrame, ranks: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
               count_col: str = "n_tokens", bytes_col: str = "decoded") -> DataFrame:
    """:func:`encode`, and :func:`decode` of its ids, in one pass through the workers."""
    def make():
        enc = byte_encoder(ranks, pattern)

        def f(texts):
            ids = [enc.encode(t) for t in texts]
            return (pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([enc.decode(x) for x in ids], pa.binary()))
        return f

    return with_columns_from(df.withColumn(text_col, text_of(text_col)), text_col, make,
                             [StructField(ids_col, BinaryType()), StructField(count_col, LongType()),
                              StructField(bytes_col, BinaryType())])
