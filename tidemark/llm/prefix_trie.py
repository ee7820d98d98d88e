"""Conversation prefix trie, by double arrays.

Every conversation is a path of turns; every distinct sequence of first turns is a
node.  Equal paths are first reduced to one, then sorted and dealt out by range, so
that a shard is a run of neighbours in prefix order (a prefix that a third of all
paths share is cut into as many shards as it needs).  A task gives a shard's turns
dense ids and packs its paths into a double array: a node is a state, its child by
turn ``c`` is state ``BASE[s] + c``, which is right if ``CHECK`` there says ``s``.
Walking the paths through the arrays counts members, going back over the states
sums the subtrees.  A shard holds at most about ``SHARD_TURNS`` turns; a longer range
is cut into several shards.

Nodes within a shard are finished there.  Only the prefixes of a shard's first and
last path can also lie in its neighbours: their counts and smallest members are
merged globally, and where shard i's last path and shard i+1's first path agree,
that common prefix was counted in both, so the merge takes off the double share:
each node above counts one child too many, the words below it are saved once more,
and a last path that goes on in the next shard was no leaf.

A conversation's turns are held as 16-byte digests with word counts, one
conversation at a time; texts stay where they are read.  Ids of the members that end
at a node are sorted by range, joined into short runs in parallel, and hashed as a
stream, so a path that a third of all conversations share needs no more memory.

Rows: rows without a conversation id belong to no conversation; a null role or text
is an empty one; turns are ordered by number (null first), equal numbers by digest,
and repeated rows are turns each.  An empty table gives no rows.  Further columns are
not read, so their names do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from .common import cut, ship, text_of, written

SHARD_TURNS = 200_000     # turns of distinct paths that one double array holds (one longer path: alone)
DIGEST = 16
ROOT = bytes(DIGEST)
KEY_TURNS = 64            # turns that the range cut looks at (so that its sample stays small)
RUN_IDS = 500             # member ids that a run of the digest stream holds
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def paths(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """``conv, path``: per conversation its turns in order, as digests with word counts."""
    role_text, body = text_of(role), text_of(text)
    whole = F.concat(F.length(role_text).cast("string"), F.lit(":"), role_text, body)
    rows = turns.filter(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST).alias("digest"),
        F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    return rows.groupBy("conv").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"),
                                                                          t["words"].alias("words"))).alias("path"))


def share_openings(own: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation ``c`` begins with the first ``h`` turns of conversation
    ``c - c % every`` and goes on with its own after its first ``h``; ``h`` is the
    CRC-32 of its decimal id modulo ``most``."""
    heads = own.filter(F.col("conv") % every == 0).select(
        F.col("conv").alias("head"), F.slice("path", 1, most - 1).alias("opening"))
    rows = own.withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")) \
              .withColumn("head", F.col("conv") - F.col("conv") % every)
    opening = F.when(F.col("opening").isNull(), F.slice("path", 1, 0)).otherwise(F.expr("slice(opening, 1, h)"))
    rest = F.expr("slice(path, h + 1, greatest(size(path) - h, 0))")
    return rows.join(heads, "head", "left").select("conv", F.concat(opening, rest).alias("path"))


def _chained(path: Column) -> Column:
    """A path's node: the digests chained from the root."""
    return F.aggregate(path, F.lit(ROOT), lambda node, t: F.substring(
        F.unhex(F.sha2(F.concat(node, t["digest"]), 256)), 1, DIGEST))


class DoubleArray:
    """``base`` and ``check`` over dense turn ids (1, 2, ...), packed from sorted distinct
    sequences.  State 0 is the root; a free cell's ``check`` is -1."""

    def __init__(self, seqs: list[list[int]]):
        self.base, self.check = [0], [0]
        self.follows = [1]               # from a cell on, where the next free one may be
        self.order = [0]                 # states, parents first
        self.code, self.depth = {0: 0}, {0: 0}
        todo = [(0, 0, 0, len(seqs))]
        while todo:
            state, depth, lo, hi = todo.pop()
            at = lo + (len(seqs[lo]) == depth)        # the path that ends here comes first
            children = []
            while at < hi:
                c, to = seqs[at][depth], at + 1
                while to < hi and seqs[to][depth] == c:
                    to += 1
                children.append((c, at, to))
                at = to
            if not children:
                continue
            base = self.base[state] = self.place([c for c, _, _ in children])
            for c, at, to in children:
                child = base + c
                self.check[child] = state
                self.follows[child] = child + 1
                self.code[child], self.depth[child] = c, depth + 1
                self.order.append(child)
                todo.append((child, depth + 1, at, to))

    def free(self, cell: int) -> int:
        """The first free cell from ``cell`` on (the arrays grow as needed)."""
        follows, seen = self.follows, []
        while True:
            if cell >= len(follows):
                self.grow(cell)
            to = follows[cell]
            if to == cell:
                break
            seen.append(cell)
            cell = to
        for c in seen:
            follows[c] = cell
        return cell

    def grow(self, cell: int) -> None:
        n = len(self.check)
        more = max(cell + 1 - n, n // 2, 64)
        self.base += [0] * more
        self.check += [-1] * more
        self.follows += range(n, n + more)

    def place(self, codes: list[int]) -> int:
        """The least base at which every child's cell is free."""
        first, check = min(codes), self.check
        cell = self.free(1)
        while len(codes) > 1:
            base = cell - first
            if base + max(codes) >= len(check):
                self.grow(base + max(codes))
            if all(check[base + c] < 0 for c in codes):
                break
            cell = self.free(cell + 1)
        return cell - first

    def child(self, state: int, code: int) -> int:
        """The child's state, or -1."""
        cell = self.base[state] + code
        return cell if 0 < cell < len(self.check) and self.check[cell] == state else -1


_NODES = StructType([
    StructField("part", LongType()), StructField("block", LongType()), StructField("node", BinaryType()),
    StructField("parent", BinaryType()), StructField("depth", LongType()), StructField("words", LongType()),
    StructField("border", BooleanType()), StructField("under_border", BooleanType()),
    StructField("ends", BooleanType()), StructField("n", LongType()), StructField("conv", LongType()),
    StructField("parent_conv", LongType()), StructField("children", LongType()), StructField("leaves", LongType()),
    StructField("tokens", LongType()),
    # of a shard's one further row: its first and last path, digests and words
    StructField("first", BinaryType()), StructField("last", BinaryType())])


def shard_nodes(shard: list[tuple[list[tuple[bytes, int]], int, int]]) -> Iterator[tuple]:
    """Nodes of one shard: sorted distinct paths, each with its members' number and
    smallest id."""
    dense: dict[bytes, int] = {}
    digests, words = [b""], [0]
    seqs = []
    for path, _, _ in shard:
        seq = []
        for digest, w in path:
            c = dense.get(digest)
            if c is None:
                c = dense[digest] = len(digests)
                digests.append(digest)
                words.append(w)
            seq.append(c)
        seqs.append(seq)
    trie = DoubleArray(seqs)
    base, check = trie.base, trie.check
    size = len(check)
    n, low = [0] * size, [None] * size
    last_states = []
    border = set()
    for k, (seq, (_, members, least)) in enumerate(zip(seqs, shard)):
        s = 0
        walked = [0]
        for c in seq:
            to = base[s] + c
            if check[to] != s:
                raise ValueError("a path left the double array")
            s = to
            walked.append(s)
        for s in walked:
            n[s] += members
            if low[s] is None or least < low[s]:
                low[s] = least
        if k in (0, len(seqs) - 1):
            border.update(walked)
        last_states.append(walked[-1])
    ends = set(last_states)
    children, leaves, tokens = [0] * size, [0] * size, [0] * size
    for s in reversed(trie.order):
        if not children[s]:
            leaves[s] = 1
        tokens[s] += (n[s] - 1) * words[trie.code[s]]
        if s:
            p = check[s]
            children[p] += 1
            leaves[p] += leaves[s]
            tokens[p] += tokens[s]
    name = {0: ROOT}
    for s in trie.order:
        p = check[s]
        if s:
            name[s] = hashlib.sha256(name[p] + digests[trie.code[s]]).digest()[:DIGEST]
        yield (name[s], name[p] if s else None, trie.depth[s], words[trie.code[s]], s in border,
               bool(s) and p in border, s in ends, n[s], low[s], low[p] if s else None, children[s], leaves[s], tokens[s])


def _packed(path: list[tuple[bytes, int]]) -> bytes:
    return b"".join(d + w.to_bytes(8, "little") for d, w in path)


def _shards(limit: int):
    def run(batches):
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(_NODES)
        part, block = TaskContext.get().partitionId(), 0

        def emit(shard):
            rows = [(part, block, *r, None, None) for r in shard_nodes(shard)]
            edge = [part, block] + [None] * (len(schema) - 4) + [_packed(shard[0][0]), _packed(shard[-1][0])]
            rows.append(tuple(edge))
            for at in range(0, len(rows), 10_000):
                cols = list(zip(*rows[at:at + 10_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        shard, held = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    path = [(t["digest"], t["words"]) for t in row["path"]]
                    if shard and held + len(path) > limit:
                        yield from emit(shard)
                        shard, held, block = [], 0, block + 1
                    shard.append((path, row["n"], row["conv"]))
                    held += len(path) + 1
        if shard:
            yield from emit(shard)
    return run


_SHARED = StructType([StructField("node", BinaryType()), StructField("d_children", LongType()),
                      StructField("d_leaves", LongType()), StructField("d_tokens", LongType())])


def _overlaps(batches):
    """For the common prefix of one shard's last and the next one's first path: what
    each of its nodes has counted twice."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, step = to_arrow_schema(_SHARED), DIGEST + 8
    for batch in batches:
        for last, after in zip(batch.column("last").to_pylist(), batch.column("after").to_pylist()):
            common = 0
            while last[common:common + step] == after[common:common + step] != b"":
                common += step
            nodes, words = [ROOT], [0]
            for at in range(0, common, step):
                nodes.append(hashlib.sha256(nodes[-1] + last[at:at + DIGEST]).digest()[:DIGEST])
                words.append(int.from_bytes(last[at + DIGEST:at + step], "little"))
            below, tokens = 0, []
            for w in reversed(words):
                below += w
                tokens.append(below)
            leaf = -1 if common == len(last) else 0
            inner = [-1] * (len(nodes) - 1) + [0]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(inner, pa.int64()),
                                              pa.array([leaf] * len(nodes), pa.int64()),
                                              pa.array(tokens[::-1], pa.int64())], schema=schema)


_RUNS = StructType([StructField("node", BinaryType()), StructField("first", LongType()), StructField("ids", StringType())])
_ENDS = StructType([StructField("node", BinaryType()), StructField("ends_sha256", StringType())])


def _runs(batches):
    """Sorted (node, id) rows to runs of ids."""
    node, ids = None, []
    for batch in batches:
        out = []
        for k, c in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist()):
            if ids and (k != node or len(ids) >= RUN_IDS):
                out.append((node, ids[0], ",".join(map(str, ids))))
                ids = []
            node = k
            ids.append(c)
        if out:
            yield _batch(out, _RUNS)
    if ids:
        yield _batch([(node, ids[0], ",".join(map(str, ids)))], _RUNS)


def _digests(batches):
    """Sorted runs to one digest per node, as a stream."""
    node, state = None, None
    for batch in batches:
        out = []
        for k, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if k != node:
                if state is not None:
                    out.append((node, state.hexdigest()))
                node, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield _batch(out, _ENDS)
    if state is not None:
        yield _batch([(node, state.hexdigest())], _ENDS)


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def end_digests(members: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of rows ``node, conv``: SHA-256 of the ids, ascending, comma
    joined."""
    runs = (members.select("node", "conv").repartitionByRange("node", "conv")
            .sortWithinPartitions("node", "conv").mapInArrow(_runs, _RUNS))
    return (runs.repartition("node").sortWithinPartitions("node", "first")
            .select("node", "ids").mapInArrow(_digests, _ENDS))


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of ``conv, path`` rows (from :func:`paths`): ``node`` and
    ``parent`` (binary names), ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``."""
    spark = conversations.sparkSession
    ship(spark)
    named = written(conversations.withColumn("node", _chained(F.col("path"))), "trie-paths")
    distinct = named.groupBy("node").agg(F.first("path").alias("path"), F.count(F.lit(1)).alias("n"),
                                         F.min("conv").alias("conv"))
    sharded = (distinct.select("path", "n", "conv").repartitionByRange(F.slice("path", 1, KEY_TURNS))
               .sortWithinPartitions("path"))
    made = written(sharded.mapInArrow(_shards(shard_turns), _NODES), "trie-nodes")
    nodes, edges = made.filter("node is not null"), made.filter("node is null")

    # one row per shard, in prefix order
    pairs = (edges.select("last", F.lead("first").over(Window.orderBy("part", "block")).alias("after"))
             .filter("after is not null"))
    shared = pairs.mapInArrow(_overlaps, _SHARED)
    zero = F.lit(0).cast("long")
    borders = (nodes.filter("border")
               .select("node", "parent", "depth", "ends", "n", "conv", "children", "leaves", "tokens")
               .unionByName(shared.select(
                   "node", F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("depth"),
                   F.lit(False).alias("ends"), zero.alias("n"), F.lit(None).cast("long").alias("conv"),
                   F.col("d_children").alias("children"), F.col("d_leaves").alias("leaves"),
                   F.col("d_tokens").alias("tokens")))
               .groupBy("node").agg(
                   F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("ends").alias("ends"),
                   F.sum("n").alias("n"), F.min("conv").alias("conv"), F.sum("children").alias("children"),
                   F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens")))
    borders = cut(borders)          # at most two paths per shard
    of_parent = borders.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    merged = borders.join(of_parent, "parent", "left")
    # within a shard a border node's global name is looked up by the shard, so no parent is a hot key
    local = (nodes.filter("border").select("part", "block", "node")
             .join(borders.select("node", F.col("conv").alias("global_conv")), "node")
             .withColumnRenamed("node", "parent"))
    inner = nodes.filter("not border and not under_border")
    under = (nodes.filter("not border and under_border").drop("parent_conv")
             .join(local, ["part", "block", "parent"]).withColumnRenamed("global_conv", "parent_conv"))
    cols = ["node", "parent", "depth", "ends", "n", "conv", "parent_conv", "children", "leaves", "tokens"]
    whole = merged.select(*cols).unionByName(inner.select(*cols)).unionByName(under.select(*cols))
    ended = whole.filter("ends").join(end_digests(named), "node")
    # a node at which no conversation ends needs no join
    out = ended.select(*cols, "ends_sha256").unionByName(
        whole.filter("not ends").select(*cols, F.lit(NO_MEMBERS).alias("ends_sha256")))
    return out.select("node", "parent", F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
                      F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                      F.col("tokens").alias("saved_tokens"), "ends_sha256")
