"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of tokens.  A queue earns ``share`` tokens of credit per
token of output and sends its next token when its credit is due, so each window
of ``window`` tokens holds the target proportions to within one token per
source, and what a queue is owed is carried into the next window.  Token ``j``
of a source with share ``p`` is due at virtual time ``(j + 0.5) / p``; the stream
is all tokens by due time (ties: source order).  That schedule has a closed form:
the number of tokens each queue has sent before stream position ``t`` follows
from ``t``, the shares and the queue lengths alone.  So no task walks the stream:
a task that knows where its documents lie in their queues cuts them into windows
by itself, and the credit carries across windows and partitions exactly.

Passes: (1) tokenise, number each document's tokens within (partition, source)
and write that once; (2) add up the partitions' totals per source into start
offsets; (3) cut.  No shuffle carries text or ids, and a source with most of the
rows is spread over as many tasks as it came in.

Rows: a null or empty text is one end-of-document token; a null source is a
queue of its own (named ""); repeated rows are packed each; an empty table gives
no rows.  A queue that runs out leaves its share to the others.
"""

from __future__ import annotations

import json
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StringType, StructField,
                               StructType)

from .common import ship, slices, text_of, written

WINDOW = 4096
MAX_SOURCES = 100_000     # rows of the per-source table a task may hold
CACHED_PIECES = 500_000   # of one generation of each worker's encoded words; it holds two
EDGE_CELLS = 1 << 20      # window edges times queues that a task holds at a time

# What the fast path below is exact for: texts of these characters only.
_PLAIN = r"[^\n\x20-\x7e\xa1-\xac\xae-\xff]"
# The word pattern it is exact for: what consists of letters only is one word.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_characters() -> dict[int, str]:
    """The byte-level alphabet: a printable byte stands for itself, the others
    follow from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Text -> ids (little-endian unsigned 32-bit) as the ``tokenizers`` library
    gives them without special tokens, with every word's ids looked up once.

    A tokenizer that lower-cases, drops white space and merges within words is
    encoded word by word (a word's ids do not depend on its neighbours); any
    other layout is encoded text by text.  Its word pattern looks at nothing
    beside the word, so a word is remembered under the same name whether it stands
    alone or in a longer run of characters.  Two generations are remembered: when the
    younger is full the older one goes, and what is asked for again moves into the younger.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            layout = json.load(f)
        # a text that may hold an added token's content goes through the library whole
        self.added = [t["content"].lower() for t in layout.get("added_tokens", [])]
        norm = [n.get("type") for n in (layout.get("normalizer") or {}).get("normalizers", [])]
        pre = (layout.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.by_word = (norm == ["NFC", "Replace", "Lowercase"] and len(pre) == 2
                        and pre[0].get("type") == "Split" and pre[0].get("invert") is True
                        and pre[0].get("behavior") == "Removed" and pre[1].get("type") == "ByteLevel"
                        and not pre[1].get("use_regex") and not pre[1].get("add_prefix_space")
                        and layout.get("post_processor") is None
                        and (pre[0].get("pattern") or {}).get("Regex") == _WORDS)
        if self.by_word:
            self.pieces = regex.compile(_WORDS).findall
            self.odd = regex.compile(_PLAIN).search
            self.alphabet = _byte_characters()
            self.young: dict[str, bytes] = {}
            self.older: dict[str, bytes] = {}

    @staticmethod
    def _raw(ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: str) -> bytes:
        got = self.young.get(chunk)
        if got is not None:
            return got
        got = self.older.get(chunk)
        if got is None:
            words = None if chunk.isalpha() else self.pieces(chunk)
            if words is None or words == [chunk]:
                shown = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.alphabet)
                got = self._raw([t.id for t in self.tok.model.tokenize(shown)])
            else:
                got = b"".join(map(self._chunk, words))
        if len(chunk) <= 64:
            if len(self.young) >= CACHED_PIECES:
                self.young, self.older = {}, self.young
            self.young[chunk] = got
        return got

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text.  A word that the texts hold many times is looked up once."""
        out, plain, lows = [b""] * len(texts), [], []
        for i, text in enumerate(texts):
            low = text.lower() if self.by_word else ""
            if not self.by_word or self.odd(text) or any(a in low for a in self.added):
                out[i] = self._raw(self.tok.encode(text, add_special_tokens=False).ids)
            else:
                plain.append(i)
                lows.append(low)
        if not plain:
            return out
        split = pc.ascii_split_whitespace(pa.array(lows, pa.large_string()))
        words = split.values.dictionary_encode()
        shown = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = [self._chunk(w) if got is None else got for w, got in zip(shown, map(self.young.get, shown))]
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        start = np.cumsum(size) - size
        word = words.indices.to_numpy()
        count = size[word]
        stop = np.concatenate([[0], np.cumsum(count)])
        ids = np.frombuffer(b"".join(known), "<u4")[
            np.arange(stop[-1]) + np.repeat(start[word] - stop[:-1], count)].tobytes()
        at = (4 * stop[split.offsets.to_numpy()]).tolist()
        for i, a, b in zip(plain, at, at[1:]):
            out[i] = ids[a:b]
        return out


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokenize_queues(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str,
                    source_col: str | None) -> DataFrame:
    """One row per document: ``doc_id, queue, ids, n_tokens``, with the partition
    it came in and its first token's place in that partition's part of the queue."""
    ship(docs.sparkSession)
    queue = text_of(source_col) if source_col else F.lit("")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"),
                       queue.alias("queue"))
    schema = StructType([
        StructField("doc_id", rows.schema["doc_id"].dataType), StructField("queue", StringType()),
        StructField("ids", BinaryType()), StructField("n_tokens", LongType()),
        StructField("part", IntegerType()), StructField("local_start", LongType())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        part, at, enc = TaskContext.get().partitionId(), {}, word_encoder(tokenizer)
        for batch in batches:
            for rows in slices(batch, "text"):
                queues = rows.column("queue").to_pylist()
                ids = [x + end for x in enc.encode_all(rows.column("text").to_pylist())]
                sizes, starts = [len(x) // 4 for x in ids], []
                for q, n in zip(queues, sizes):
                    starts.append(at.get(q, 0))
                    at[q] = starts[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("queue"), pa.array(ids, pa.binary()),
                     pa.array(sizes, pa.int64()), pa.array([part] * len(ids), pa.int32()),
                     pa.array(starts, pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


class Schedule:
    """Tokens each queue has sent before a stream position."""

    def __init__(self, totals, shares):
        self.n = np.asarray(totals, np.float64)
        p = np.asarray(shares, np.float64)
        self.p = p / p.sum() if len(p) else p
        self.total = int(sum(int(t) for t in totals))

    def sent(self, positions) -> np.ndarray:
        """One row per position, one column per queue; each row adds up to its position."""
        t = np.minimum(np.asarray(positions, np.int64), self.total)
        if not len(self.n):
            return np.zeros((len(t), 0), np.int64)
        lo, hi = np.full(len(t), -1.0), np.full(len(t), float((self.n / self.p).max()) + 2.0)
        upto = lambda x: np.minimum(self.n, np.floor(x[:, None] * self.p + 0.5))
        for _ in range(100):      # least time by which t tokens are due
            mid = (lo + hi) / 2
            if not ((mid > lo) & (mid < hi)).any():
                break
            enough = upto(mid).sum(1) >= t
            hi, lo = np.where(enough, mid, hi), np.where(enough, lo, mid)
        q = np.maximum(upto(hi), 0).astype(np.int64)
        for row in np.flatnonzero(q.sum(1) != t):   # several due at once: the first queues go
            over = int(q[row].sum() - t[row])
            due = np.where(q[row] > 0, (q[row] - 0.5) / self.p, -1.0)
            last = np.lexsort((np.arange(len(due)), due))[::-1]
            q[row, last[:over]] -= 1
        return q


class Edges:
    """The table of window edges that a task holds: what each queue has sent before
    each of a run of windows.  At most ``cells`` numbers."""

    def __init__(self, plan: Schedule, window: int, cells: int):
        self.plan, self.window = plan, window
        queues = max(len(plan.n), 1)
        self.slack = queues + 1
        self.most = max(2, cells // queues)
        self.rows = max(1, cells // queues)
        self.windows = -(-plan.total // window)
        self.first = 0
        self.edge = self.before = np.zeros((0, len(plan.n)), np.int64)

    def around(self, queue: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows (from, before) that tokens ``start .. stop - 1`` of a queue can lie in."""
        def rank(at):
            due = (at + 0.5) / self.plan.p[queue]
            return np.concatenate([np.zeros(0)] + [
                np.minimum(self.plan.n, np.floor(due[i:i + self.rows, None] * self.plan.p + 0.5)).sum(1)
                for i in range(0, len(due), self.rows)])

        low = np.maximum(0, (rank(start) - self.slack).astype(np.int64) // self.window)
        high = (rank(stop) + self.slack).astype(np.int64) // self.window + 1
        return low, np.minimum(self.windows, high)

    def groups(self, queue: np.ndarray, start: np.ndarray, stop: np.ndarray):
        """The runs of tokens as lists of (row, start, stop) that one table serves.  A
        run whose windows are too many for a table is halved: a rare queue sends its
        tokens over a long stretch of the stream."""
        low, high = self.around(queue, start, stop)
        rows = np.arange(len(queue))
        while len(wide := np.flatnonzero((high - low > self.most) & (stop - start > 1))):
            half = (start[wide] + stop[wide]) // 2
            rows, queue = np.append(rows, rows[wide]), np.append(queue, queue[wide])
            start, stop = np.append(start, half), np.append(stop, stop[wide])
            stop[wide] = half
            low, high = self.around(queue, start, stop)
        held, w0, w1 = [], 0, 0
        for x in np.lexsort((start, low)).tolist():
            if held and max(w1, int(high[x])) - w0 > self.most:
                self.load(w0, w1)
                yield held
                held = []
            w0, w1 = (w0, max(w1, int(high[x]))) if held else (int(low[x]), int(high[x]))
            held.append((int(rows[x]), int(start[x]), int(stop[x])))
        if held:
            self.load(w0, w1)
            yield held

    def load(self, w0: int, w1: int) -> None:
        if w0 < self.first or w1 >= self.first + len(self.edge):
            self.first = w0
            self.edge = self.plan.sent(np.arange(w0, w1 + 1, dtype=np.int64) * self.window)
            sizes = np.diff(self.edge, axis=0)
            self.before = np.cumsum(sizes, axis=1) - sizes


def cut_pieces(rows: DataFrame, totals: list[tuple[str, int]], targets: dict[str, float] | None,
               window: int, cells: int = EDGE_CELLS) -> DataFrame:
    """Cut queued documents (with ``start`` in their queue) into windows."""
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"{len(totals)} sources; a mixture may have {MAX_SOURCES}")
    names = [q for q, _ in totals]
    counts = [n for _, n in totals]
    shares = [n if targets is None else targets.get(q, 0.0) for q, n in totals]
    if targets is not None:       # what has no target still goes out whole, as slowly as it may
        if any(s < 0 for s in shares):
            raise ValueError("a target share is negative")
        least = sum(s for s in shares if s > 0) or 1.0
        shares = [s if s > 0 else least * 1e-6 for s in shares]
    schema = StructType([
        StructField("doc_id", rows.schema["doc_id"].dataType), StructField("source", StringType()),
        StructField("start", LongType()), StructField("length", LongType()),
        StructField("doc_tokens", LongType()), StructField("sequence_id", LongType()),
        StructField("offset", LongType()), StructField("ids", BinaryType())])
    rows = rows.select("doc_id", "queue", "ids", "start")

    def run(batches):
        at = {q: k for k, q in enumerate(names)}
        table = Edges(Schedule(counts, shares), window, cells)
        for batch in batches:
            for part in slices(batch, "ids"):
                docs, ids = part.column("doc_id"), part.column("ids").to_pylist()
                queues = part.column("queue").to_pylist()
                n = np.array([len(x) // 4 for x in ids], np.int64)
                a = part.column("start").to_numpy(zero_copy_only=False).astype(np.int64)
                k = np.array([at[q] for q in queues], np.int64)
                for group in table.groups(k, a, a + n):
                    out = {name: [] for name in schema.names}
                    take = out.pop("doc_id")
                    edge, before, first = table.edge, table.before, table.first
                    for i, s, e in group:
                        own, col = int(a[i]), edge[:, k[i]]
                        w = int(np.searchsorted(col, s, "right")) - 1
                        while s < e:
                            stop = min(e, int(col[w + 1]))
                            if stop > s:
                                take.append(i)
                                out["source"].append(queues[i])
                                out["start"].append(s - own)
                                out["length"].append(stop - s)
                                out["doc_tokens"].append(int(n[i]))
                                out["sequence_id"].append(first + w)
                                out["offset"].append(int(before[w, k[i]]) + s - int(col[w]))
                                out["ids"].append(ids[i][4 * (s - own):4 * (stop - own)])
                                s = stop
                            w += 1
                    yield pa.RecordBatch.from_arrays(
                        [docs.take(pa.array(take, pa.int64()))]
                        + [pa.array(out[f.name], pa.string() if f.name == "source" else
                                    pa.binary() if f.name == "ids" else pa.int64())
                           for f in schema.fields[1:]], names=schema.names)

    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW,
         targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
         source_col: str | None = "source") -> DataFrame:
    """Pack every document into windows of ``window`` tokens.

    ``targets``: token share by source (default: each source's share of all
    tokens, so that every window looks like the corpus).  One row per piece:
    ``doc_id, source, start, length, doc_tokens, sequence_id, offset, ids``.
    Only the last window can be short.
    """
    rows = written(tokenize_queues(docs, tokenizer, end_id, id_col, text_col, source_col), "queues")
    per_part = rows.groupBy("queue", "part").agg(F.sum("n_tokens").alias("n"))
    per_part = written(per_part, "queue-parts")
    totals = [(r.queue, int(r.n)) for r in
              per_part.groupBy("queue").agg(F.sum("n").alias("n")).orderBy("queue")
              .limit(MAX_SOURCES + 1).collect()]
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("queue", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = rows.join(base, ["queue", "part"]).withColumn("start", F.col("base") + F.col("local_start"))
    return cut_pieces(placed, totals, targets, window)
