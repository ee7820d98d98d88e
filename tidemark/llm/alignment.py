"""Cross-tokenizer alignment: how two tokenizers' tokens of one text correspond.

A text's tokens under either tokenizer end at byte offsets.  Two dictionaries take
an end to the place of its token in the id list; the ends in both (a hash-set
intersection of the keys), sorted, slice the two id lists into groups that cover
the same bytes, the finest there are.  Within a slice every A token is linked to
every B token whose bytes overlap its own (a slice of m and n tokens holds
m + n - 1 links).  How often a pair of ids is linked is counted over the whole
corpus, and a link is a best one when no pair with its B id is linked more often.

Where neither tokenizer joins what lies on both sides of a space or a line end (which
is checked on their vocabularies and layouts), a text's alignment is its words'
alignments one after the other, since every word's end is a common end.  Words are then
aligned once, in batches, and remembered (two bounded generations per worker); texts
with other white space, or tokenizers of another kind, are aligned whole.

Passes: (1) one pass over the texts tokenises, aligns and writes, in blocks of about
``BLOCK_LINKS`` links, each document's linked pairs as places in its block's list of
distinct pairs, and that list with its totals; (2) the blocks' totals are added up by
pair (a pair comes once per block, however common it is), and the most per B id is
taken (at most one row per id of B's vocabulary); (3) the counts go back to the
blocks' lists, and each block's documents are summed beside them.  A task holds one
block; no shuffle carries text or ids.

Rows: a text that is null or empty, or that the joined token bytes of either side do
not reproduce, has no tokens: zeros and empty groups.  Repeated rows are aligned and
counted each; an empty table gives no rows.  Added columns replace columns of the
same name (case aside); other columns stay, except the text.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .common import as_one, ship, slices, text_of, written

BLOCK_LINKS = 2 << 20     # links after which a block ends (one longer document is a block alone)
BLOCK_DOCS = 20_000
BATCH_BYTES = 1 << 20     # text that is tokenised at a time
CACHED_WORDS = 300_000    # words of one generation of a worker's memory
LONGEST_CACHED = 48
WORDS_TOGETHER = 64       # fresh words that are aligned in one go
COUNT_BITS = 40           # three counts are kept, and added up, as one number
MOST_IDS = 1 << 24        # B vocabularies up to this size: their one row per id may be broadcast
SPACE_MARK = "▁"


class ByteLevelSide:
    """A byte-level tokenizer of the ``tokenizers`` library; codes a space and the text."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True     # their strings in a text are plain text
        with open(path, encoding="utf-8") as f:
            layout = json.load(f)
        vocabulary, pre = layout["model"]["vocab"], layout.get("pre_tokenizer") or {}
        # the usual split: white space but one space before a word stands alone
        self.by_word = (layout.get("normalizer") is None and pre.get("type") == "ByteLevel"
                        and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        byte_of = {c: b for b, c in byte_alphabet().items()}
        self.bytes = [b""] * (max([*vocabulary.values(), self.tok.get_vocab_size() - 1]) + 1)
        for entry, i in vocabulary.items():
            if all(c in byte_of for c in entry):
                self.bytes[i] = bytes(byte_of[c] for c in entry)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def encode_lines(self, texts: list[str]) -> list[list[int]]:
        """Texts that begin with a line end, as they stand."""
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide:
    """A sentence-piece model with byte pieces; it puts the space in front itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                              else piece.replace(SPACE_MARK, " ").encode())
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.mark = self.model.piece_to_id(SPACE_MARK)
        # no piece goes on after a space, or holds a line end
        self.by_word = (not any(SPACE_MARK in p.lstrip(SPACE_MARK) or "\n" in p for p in pieces)
                        and not self.model.is_unknown(self.mark))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def encode_lines(self, texts: list[str]) -> list[list[int]]:
        """Texts that begin with a line end, without the space that the model puts in front."""
        return [ids[1:] if ids[0] == self.mark else [] for ids in self.encode(texts)]


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: a printable byte stands for itself, the others follow
    from code point 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def side(kind: str, path: str):
    made = {"byte_level": ByteLevelSide, "piece": PieceSide}[kind](path)
    made.lengths = list(map(len, made.bytes))
    made.shown = list(map(str, range(len(made.bytes))))
    return made


def common_cuts(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Where both id lists are cut: for each end that both have, the number of A and
    of B tokens up to it."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    common = sorted(at_a.keys() & at_b.keys())
    return list(map(at_a.__getitem__, common)), list(map(at_b.__getitem__, common))


def slice_links(ends_a: list[int], ends_b: list[int], i: int, i1: int, j: int, j1: int) -> Iterator[tuple[int, int]]:
    """Places of the overlapping tokens of one slice (tokens ``i:i1`` and ``j:j1``)."""
    while i < i1 and j < j1:
        yield i, j
        a, b = ends_a[i], ends_b[j]
        i += a <= b
        j += b <= a


def align(ids_a: list[int], ids_b: list[int], ends_a: list[int], ends_b: list[int], cuts_a: list[int],
          cuts_b: list[int], i: int, j: int, shown_a: list[str], shown_b: list[str], width: int) -> tuple[str, list[int]]:
    """Groups of the slices from ``i`` and ``j`` on, up to each pair of cuts, as text
    (``a1,a2|b1;a3|b2``), and each link's pair of ids as one number (A's id times
    ``width`` plus B's)."""
    groups, links = [], []
    add, link = groups.append, links.append
    for i1, j1 in zip(cuts_a, cuts_b):
        if i1 - i == 1:
            a = ids_a[i]
            if j1 - j == 1:
                b = ids_b[j]
                add(shown_a[a] + "|" + shown_b[b])
                link(a * width + b)
            else:
                part = ids_b[j:j1]
                add(shown_a[a] + "|" + ",".join([shown_b[b] for b in part]))
                links += [a * width + b for b in part]
        else:
            part = ids_a[i:i1]
            add(",".join([shown_a[a] for a in part]) + "|" + ",".join([shown_b[b] for b in ids_b[j:j1]]))
            if j1 - j == 1:
                b = ids_b[j]
                links += [a * width + b for a in part]
            else:
                links += [ids_a[x] * width + ids_b[y] for x, y in slice_links(ends_a, ends_b, i, i1, j, j1)]
        i, j = i1, j1
    return ";".join(groups), links


class Block:
    """Documents whose linked pairs are still held, by place in one list."""

    def __init__(self):
        self.rows, self.links, self.held, self.docs = [], [], 0, 0

    def add(self, links: bytes) -> None:
        self.links.append(np.frombuffer(links, "<i8"))
        self.held += len(links) // 8
        self.docs += 1

    @property
    def full(self) -> bool:
        return self.held >= BLOCK_LINKS or self.docs >= BLOCK_DOCS

    def packed(self) -> tuple[list[bytes], list[bytes], np.ndarray, np.ndarray]:
        """Per document its distinct pairs (places in the block's list, as steps) and
        how often it has each; the block's list and totals."""
        sizes = [len(x) for x in self.links]
        coded = pa.array(np.concatenate(self.links) if self.links else np.zeros(0, np.int64)).dictionary_encode()
        met = coded.dictionary.to_numpy()       # in the order they are met
        order = np.argsort(met)
        rank = np.empty(len(met), np.int64)
        rank[order] = np.arange(len(met))
        pairs, place = met[order], rank[coded.indices.to_numpy()]
        totals = np.bincount(place, minlength=len(pairs)).astype(np.int64)
        steps, times, at = [], [], 0
        for n in sizes:
            seen, often = np.unique(place[at:at + n], return_counts=True)
            at += n
            steps.append(np.diff(seen, prepend=0).astype("<i4").tobytes())
            times.append(often.astype("<i4").tobytes())
        return steps, times, pairs, totals


_OWN = [("n_a", LongType()), ("n_b", LongType()), ("n_groups", LongType()), ("n_links", LongType()),
        ("groups", StringType()), ("groups_sha256", StringType())]


class Aligner:
    """Alignments of texts, by words where the tokenizers allow it."""

    def __init__(self, a, b):
        self.a, self.b, self.width = a, b, len(b.bytes)
        self.by_word = a.by_word and b.by_word
        self.words: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def _whole(self, raw: bytes, x: list[int], y: list[int], ends: list[int]) -> list[tuple] | None:
        """Groups, counts and links (as bytes) of each part of a text, the parts ending at
        ``ends``.  None where a side does not reproduce the bytes or a part's end is no
        common one."""
        a, b, width = self.a, self.b, self.width
        if b"".join(map(a.bytes.__getitem__, x)) != raw or b"".join(map(b.bytes.__getitem__, y)) != raw:
            return None
        ends_a = list(accumulate(map(a.lengths.__getitem__, x)))
        ends_b = list(accumulate(map(b.lengths.__getitem__, y)))
        at_a, at_b = common_cuts(ends_a, ends_b)
        place = dict(zip(map(ends_a.__getitem__, (i - 1 for i in at_a)), range(1, len(at_a) + 1)))
        out, k, i, j = [], 0, 0, 0
        for end in ends:
            to = place.get(end)
            if to is None:
                return None
            i1, j1 = at_a[to - 1], at_b[to - 1]
            groups, links = align(x, y, ends_a, ends_b, at_a[k:to], at_b[k:to], i, j, a.shown, b.shown, width)
            out.append((groups, to - k | (i1 - i) << COUNT_BITS | (j1 - j) << 2 * COUNT_BITS,
                        struct.pack(f"<{len(links)}q", *links)))
            k, i, j = to, i1, j1
        return out

    def _learn(self, words: list[str], lines: bool) -> None:
        """Align words that follow a space, or that begin with a line end, put together."""
        encode_a, encode_b = (self.a.encode_lines, self.b.encode_lines) if lines else (self.a.encode, self.b.encode)
        sep, space = ("", 0) if lines else (" ", 1)
        batches = [words[i:i + WORDS_TOGETHER] for i in range(0, len(words), WORDS_TOGETHER)]
        texts = [sep.join(batch) for batch in batches]
        for batch, text, x, y in zip(batches, texts, encode_a(texts), encode_b(texts)):
            raw = (" " * space + text).encode()
            ends = list(accumulate(len(w.encode()) + space for w in batch))
            got = self._whole(raw, x, y, ends)
            if got is not None:
                self.words.update(zip(batch, got))
            elif len(batch) == 1:
                self.words[batch[0]] = None
            else:               # one of them is not reproduced: each by itself
                for w in batch:
                    self._learn([w], lines)

    def align(self, texts: list[str]) -> list[tuple | None]:
        """Per text its groups, counts (of groups, A and B tokens) and links (as bytes);
        None for one without tokens."""
        split = [t.replace("\n", " \n").split(" ") if self.by_word and t and by_single(t) else None for t in texts]
        known, older = self.words, self.older
        fresh = set().union(*(words for words in split if words is not None)).difference(known)
        held = fresh.intersection(older)
        known.update(zip(held, map(older.__getitem__, held)))
        fresh -= held
        for lines in (False, True):
            self._learn([w for w in fresh if (w[0] == "\n") == lines], lines)
        out = []
        for text, words in zip(texts, split):
            if not text:
                out.append(None)
            elif words is None:
                raw = (" " + text).encode()
                got = self._whole(raw, self.a.encode([text])[0], self.b.encode([text])[0], [len(raw)])
                out.append(got and unpacked(got[0]))
            else:
                parts = list(map(known.__getitem__, words))
                if None in parts:
                    out.append(None)
                else:
                    groups, counts, links = zip(*parts)
                    out.append(unpacked((";".join(groups), sum(counts), b"".join(links))))
        for w in fresh:
            if len(w) > LONGEST_CACHED:
                del known[w]
        if len(known) > CACHED_WORDS:
            self.older, self.words = known, {}
        return out


def by_single(text: str) -> bool:
    """Whether the only white space is single spaces and line ends between words."""
    return text.replace("\n", " ").split(" ") == text.split()


def unpacked(got: tuple[str, int, bytes]) -> tuple[str, int, int, int, bytes]:
    groups, counts, links = got
    mask = (1 << COUNT_BITS) - 1
    return groups, counts & mask, counts >> COUNT_BITS & mask, counts >> 2 * COUNT_BITS, links


@lru_cache(maxsize=2)
def aligner(a: tuple[str, str], b: tuple[str, str]) -> Aligner:
    return Aligner(side(*a), side(*b))


def _stage(text: str, kept: list[StructField], out: StructType, a_of: tuple[str, str], b_of: tuple[str, str],
           with_groups: bool) -> Callable:
    """The task of the first pass: rows of documents and, after each block's, its list."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)
    names = [f.name for f in kept]

    longs = schema.field("pairs").type

    def emit(block: Block, number: int):
        steps, times, pairs, totals = block.packed()
        at = 0
        for part, made in block.rows:
            n = part.num_rows
            cols = part.columns + [pa.array(c, schema.field(len(names) + k).type) for k, c in enumerate(zip(*made))]
            cols += [pa.array([number] * n, pa.int64()), pa.array(steps[at:at + n], pa.binary()),
                     pa.array(times[at:at + n], pa.binary()), pa.nulls(n, longs), pa.nulls(n, longs)]
            at += n
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)
        listed = [pa.nulls(1, c.type) for c in part.columns] + [pa.nulls(1, f.type) for f in list(schema)[len(names):]]
        listed[-5:-4] = [pa.array([number], pa.int64())]
        listed[-2:] = [pa.array([pairs.tolist()], longs), pa.array([totals.tolist()], longs)]
        yield pa.RecordBatch.from_arrays(listed, names=schema.names)

    def run(batches):
        from pyspark import TaskContext

        aligned = aligner(a_of, b_of).align
        number = TaskContext.get().partitionId() << 32
        block = Block()
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                held, made, start = part.select(names), [], 0
                for k, got in enumerate(aligned(part.column(text).to_pylist())):
                    groups, n, n_a, n_b, links = got or ("", 0, 0, 0, b"")
                    sha = hashlib.sha256(groups.encode()).hexdigest() if n else ""
                    made.append((n_a, n_b, n, len(links) // 8, groups if with_groups else None, sha))
                    block.add(links)
                    if block.full:
                        block.rows.append((held.slice(start, k + 1 - start), made))
                        yield from emit(block, number)
                        block, number, made, start = Block(), number + 1, [], k + 1
                if made:
                    block.rows.append((held.slice(start), made))
        if block.docs:
            yield from emit(block, number)

    return run


def _summed(kept: list[str]) -> Callable:
    """One block: its documents beside the corpus counts of its list."""
    def f(docs: pa.Table, counts: pa.Table) -> pa.Table:
        place = counts.column("place").to_numpy()
        count = np.zeros(len(place), np.int64)
        best = np.zeros(len(place), np.int64)
        count[place] = counts.column("count").to_numpy()
        best[place] = counts.column("best").to_numpy()
        n_best, total = [], []
        for s, t in zip(docs.column("steps").to_pylist(), docs.column("times").to_pylist()):
            seen = np.cumsum(np.frombuffer(s, "<i4"), dtype=np.int64)
            often = np.frombuffer(t, "<i4").astype(np.int64)
            n_best.append(int((best[seen] * often).sum()))
            total.append(int((count[seen] * often).sum()))
        return docs.select(kept).append_column("n_best", pa.array(n_best, pa.int64())) \
                   .append_column("count_sum", pa.array(total, pa.int64()))
    return f


def align_corpus(df: DataFrame, a: tuple[str, str], b: tuple[str, str], text_col: str = "text",
                 with_groups: bool = True) -> tuple[DataFrame, DataFrame]:
    """Per document ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` (left out
    where ``with_groups`` is false) and ``groups_sha256``; and the counts of all linked
    pairs (``a_id, b_id, count, best``).  ``a`` and ``b`` are (kind, path of the file):
    kind ``byte_level`` or ``piece``."""
    spark = df.sparkSession
    ship(spark)
    own = [StructField(n, t) for n, t in _OWN]
    taken = {n for n, _ in _OWN} | {"n_best", "count_sum", text_col.lower()}
    # the caller's columns travel as one, so no name of theirs can meet one of ours
    others = [c for c in df.columns if c.lower() not in taken]
    rows = df.select(as_one(others).alias("row"), text_of(text_col).alias("text"))
    kept = [StructField("row", rows.schema["row"].dataType)]
    out = StructType(kept + own + [
        StructField("block", LongType()), StructField("steps", BinaryType()), StructField("times", BinaryType()),
        StructField("pairs", ArrayType(LongType())), StructField("totals", ArrayType(LongType()))])
    staged = written(rows.mapInArrow(_stage("text", kept, out, a, b, with_groups), out), "alignment")

    width = len(side(*b).bytes)
    listed = (staged.filter(F.col("pairs").isNotNull())
              .select("block", F.posexplode(F.arrays_zip("pairs", "totals")).alias("place", "of"))
              .select("block", "place", F.col("of.pairs").alias("pair"), F.col("of.totals").alias("total")))
    counted = written(listed.groupBy("pair").agg(F.sum("total").alias("count"))
                      .withColumn("b_id", F.col("pair") % F.lit(width)), "alignment-counts")
    most = counted.groupBy("b_id").agg(F.max("count").alias("most"))
    most = F.broadcast(most) if width <= MOST_IDS else most      # at most one row per id of B
    scored = counted.join(most, "b_id").select(
        "pair", "b_id", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    back = listed.select(F.col("block").alias("of_block"), "place", "pair").join(scored.select("pair", "count", "best"), "pair") \
                 .select("of_block", "place", "count", "best")
    docs = staged.filter(F.col("pairs").isNull()).drop("pairs", "totals")
    keep = ["row", "n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256"]
    result = StructType([docs.schema[c] for c in keep] + [StructField("n_best", LongType()),
                                                         StructField("count_sum", LongType())])
    summed = (docs.groupBy("block").cogroup(back.groupBy("of_block"))
              .applyInArrow(_summed(keep), result))
    final = summed.select(*[F.col("row").getField(c).alias(c) for c in others], "n_a", "n_b", "n_groups", "n_links",
                          "n_best", "count_sum", *(["groups"] if with_groups else []), "groups_sha256")
    pairs = scored.select(F.expr(f"pair div {width}").alias("a_id"), "b_id", "count", (F.col("best") == 1).alias("best"))
    return final, pairs
