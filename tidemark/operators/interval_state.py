"""The state of a stream-stream interval join, kept by bucket.

Spark's own join of two streams looks up, puts and removes its state row by row; that is
most of the work of a large join.  Here the rows are dealt by the hash of their key into
buckets: a task packs its rows of a bucket into one Arrow block, Spark brings a bucket's
blocks together, and a stateful function (``applyInPandasWithState``) joins the new rows
with the bucket's waiting ones and leaves both sides in the state as a block each.

What comes out is what Spark's join gives: a pair as soon as both rows are there, and for
``left_outer`` a left row without a partner once the watermark (the lesser one of both
sides) says that none can come; a row is let go when no later row can pair with it.  A
row at or behind the watermark by which its bucket was last cleared is late and dropped.

A batch reads and writes the buckets that it touches whole, and a bucket's waiting rows
are in one task's memory at a time: ``buckets`` is for these, ``salts`` for a hot key.  A
bucket has rows of one salt only; a right row is packed once, and its block goes to the
bucket of every salt.  Blocks that are shuffled or kept are ordered by a whole-number key
and compressed, and have the rows' own columns: a join's state is a copy of all rows that
wait, on the executor's disk and in the checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    BinaryType, BooleanType, DateType, DayTimeIntervalType, DecimalType, FractionalType, IntegerType, IntegralType, StringType,
    StructField, StructType, TimestampNTZType, TimestampType,
)

BUCKETS = 1024
_PACK_ROWS = 1_000_000      # rows that a task packs at once
_OUT_ROWS = 100_000         # rows of a result block
_WATERMARK = "spark.watermarkDelayMs"       # in the metadata of a column with a watermark
_BUCKET, _KEY = "tidemark_bucket", "tidemark_key"
_STATE = "cleared long, left binary, right binary"
_PLAIN = (IntegralType, FractionalType, StringType, BinaryType, BooleanType, DateType, TimestampType, TimestampNTZType)


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _micros(frame: DataFrame, interval: str) -> int | None:
    """An interval of days to seconds in microseconds; None for months."""
    one = frame.sparkSession.range(1).select(F.expr(f"INTERVAL {interval}").alias("i"))
    if not isinstance(one.schema["i"].dataType, DayTimeIntervalType):
        return None
    return one.first().i // timedelta(microseconds=1)


def _key(frame: DataFrame, names: Sequence[str], types: Sequence) -> Column:
    """The key as one value, equal where Spark finds the columns equal; null where one is null."""
    if len(names) == 1 and isinstance(types[0], IntegralType):
        return _col(names[0]).cast("bigint")
    texts = []
    for name, kind in zip(names, types):
        c = _col(name)
        if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
            c = c + F.lit(0.0).cast(kind)           # -0.0 equals 0.0
        elif isinstance(kind, TimestampType):
            c = F.unix_micros(c)
        elif isinstance(kind, BinaryType):
            c = F.hex(c)
        texts += [F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")]
    return F.concat(*texts)


def can_keep_by_bucket(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_time: str, right_time: str,
                       lower: str, upper: str) -> bool:
    """Whether this join is one of two streams with watermarks, in plain columns, with keys
    of the same type on both sides and bounds of a fixed length."""
    sides = [(left, [a for a, _ in on], left_time), (right, [b for _, b in on], right_time)]
    for frame, names, time in sides:
        if not frame.isStreaming or not set(names) | {time} <= set(frame.columns) or len(set(frame.columns)) < len(frame.columns):
            return False
        if not isinstance(frame.schema[time].dataType, TimestampType) or _WATERMARK not in frame.schema[time].metadata:
            return False
    fields = [*left.schema.fields, *right.schema.fields]
    text = [f.dataType for f in fields if isinstance(f.dataType, StringType)]
    pairs = [(left.schema[a].dataType, right.schema[b].dataType) for a, b in on]
    return (bool(pairs) and all(isinstance(f.dataType, _PLAIN) for f in fields) and all(t == StringType() for t in text)
            and all(a == b or (len(on) == 1 and isinstance(a, IntegralType) and isinstance(b, IntegralType)) for a, b in pairs)
            and _micros(left, lower) is not None and _micros(left, upper) is not None)


def _packer(time: str, key: str, ordered: bool, is_left: bool, copies: int, rows: int, schema):
    """The task's function: rows to one block a bucket, in the columns of ``schema`` (Arrow's),
    whatever zone the session shows times in; ``ordered`` by the key, if it is a whole number.
    With ``copies`` a block goes to so many buckets in a row.  It is made here, like the
    others, so that workers need not import this package."""
    def pack(batches):
        import numpy as np
        import pyarrow as pa

        options = pa.ipc.IpcWriteOptions(compression="zstd")
        last = np.datetime64("2262-01-01").astype("datetime64[us]").astype("int64")      # of what pandas can hold

        def blocks(held):
            table = pa.Table.from_batches(held)
            if not is_left:
                table = table.filter(table.column(key).is_valid())
                if not table.num_rows:
                    return
            bucket = table.column("tidemark_bucket").to_numpy()
            if ordered:
                order = np.lexsort((table.column(key).cast(pa.int64()).fill_null(0).to_numpy(), bucket))
            else:
                order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            table = table.drop_columns(["tidemark_bucket"]).cast(schema).take(pa.array(order)).combine_chunks()
            at = table.column(time).cast(pa.int64()).to_numpy()
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            data = []
            for a, b in zip(starts, np.r_[starts[1:], len(bucket)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
                    writer.write_table(table.slice(a, b - a))
                data.append(sink.getvalue())
            latest = np.maximum.reduceat(at, starts)
            latest = pa.array(latest, pa.int64(), mask=np.abs(latest) > last).cast(pa.timestamp("us", "UTC"))
            for a in range(0, len(data), 64):
                part = slice(a, a + 64)
                packed = pa.array([d.to_pybytes() for d in data[part]], pa.binary())
                for copy in range(copies):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[starts[part]] + copy, pa.int32()), pa.array([is_left] * len(packed), pa.bool_()),
                         latest[part], packed], ["bucket", "is_left", "at", "block"])

        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= rows:
                yield from blocks(held)
                held, n = [], 0
        if held:
            yield from blocks(held)

    return pack


def _joiner(left_time: str, right_time: str, left_key: str, right_key: str, extra: Sequence[str], ordered: bool,
            lower: int, upper: int, outer: bool, out_rows: int):
    """The task's function: a bucket's new rows against its waiting ones.  ``extra`` are
    the columns of a block that are not the rows' own."""
    def join(_, frames, state):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        def read(block):
            return pa.ipc.open_stream(block).read_all()

        def write(table, compression):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=compression)) as writer:
                writer.write_table(table.combine_chunks())
            return sink.getvalue().to_pybytes()

        def keep(table, key):
            if table is None:
                return None
            if ordered:
                table = table.take(pa.array(np.argsort(whole(table.column(key)).fill_null(0).to_numpy(), kind="stable")))
            return write(table, "zstd")

        def whole(column):
            return column.cast(pa.int64()).combine_chunks() if ordered else column.combine_chunks()

        def times(table, column):
            return table.column(column).cast(pa.int64()).to_numpy()

        def both(a, b):
            return a if b is None else b if a is None else pa.concat_tables([a, b])

        def pairs(left, right):
            """Row numbers of all pairs, in pieces: right rows are ordered by key and time, so that
            a left row's partners are a run among them."""
            keys, known = whole(left.column(left_key)), whole(right.column(right_key))
            has_key = keys.is_valid().to_numpy(zero_copy_only=False)
            if ordered:
                keys, known = keys.fill_null(0).to_numpy(), known.to_numpy()
            else:
                codes = pa.chunked_array([keys.fill_null(""), known]).combine_chunks().dictionary_encode().indices.to_numpy()
                keys, known = codes[:len(keys)], codes[len(keys):]
            distinct, known = np.unique(known, return_inverse=True)
            code = np.minimum(np.searchsorted(distinct, keys), len(distinct) - 1)
            rows = np.flatnonzero(has_key & (distinct[code] == keys))
            code = code[rows].astype(np.int64)
            at, seen = times(left, left_time)[rows], times(right, right_time)
            moments, seen = np.unique(seen, return_inverse=True)
            step = len(moments) + 1
            place = known.astype(np.int64) * step + seen
            order = np.argsort(place, kind="stable")
            place = place[order]
            first = np.searchsorted(place, code * step + np.searchsorted(moments, at + lower, "left"), "left")
            n = np.searchsorted(place, code * step + np.searchsorted(moments, at + upper, "right"), "left") - first
            n = np.maximum(n, 0)
            total, start = np.cumsum(n), 0
            while start < len(rows):        # a piece of about ``out_rows`` pairs at a time
                stop = max(start + 1, np.searchsorted(total, total[start] - n[start] + out_rows, "right"))
                of = slice(start, stop)
                run = np.arange(n[of].sum()) - np.repeat(np.cumsum(n[of]) - n[of], n[of])
                if len(run):
                    yield np.repeat(rows[of], n[of]), order[np.repeat(first[of], n[of]) + run]
                start = stop

        def emit(left, right):
            columns = {**{f"l{i}": c for i, c in enumerate(left.drop_columns([*extra, "tidemark_matched"]).columns)},
                       **({} if right is None else {f"r{i}": c for i, c in enumerate(right.drop_columns(extra).columns)})}
            return pd.DataFrame({"block": [write(pa.table(columns), "lz4")]})

        limit = state.getCurrentWatermarkMs()
        cleared, old_left, old_right = state.get if state.exists else (None, None, None)
        old_left, old_right = (None if b is None else read(bytes(b)) for b in (old_left, old_right))
        new = {True: None, False: None}
        for frame in frames:
            for is_left in (True, False):
                tables = [read(b) for b in frame["block"][frame["is_left"] == is_left]]
                if not tables:
                    continue
                table = pa.concat_tables(tables)
                if cleared is not None:
                    table = table.filter(pa.array(times(table, left_time if is_left else right_time) > cleared * 1000))
                if table.num_rows:
                    new[is_left] = both(new[is_left], table)
        if new[True] is not None:
            new[True] = new[True].append_column("tidemark_matched", pa.array(np.zeros(new[True].num_rows, bool)))
        left, right = both(old_left, new[True]), both(old_right, new[False])

        if left is not None and right is not None:
            matched = left.column("tidemark_matched").to_numpy().copy()
            before = 0 if old_left is None else old_left.num_rows
            # waiting left rows meet the new right ones, new left rows all right ones
            for some, others, offset in ((old_left, new[False], 0), (new[True], right, before)):
                if some is None or others is None:
                    continue
                for a, b in pairs(some, others):
                    matched[a + offset] = True
                    yield emit(some.take(pa.array(a)), others.take(pa.array(b)))
            left = left.set_column(left.column_names.index("tidemark_matched"), "tidemark_matched", pa.array(matched))

        due = []        # when the bucket has to be looked at again, in microseconds
        if left is not None:
            ends, alone = times(left, left_time) + upper, ~left.column("tidemark_matched").to_numpy()
            stay = ends > limit * 1000
            if outer:
                over = left.filter(pa.array(~stay & alone))
                for at in range(0, over.num_rows, out_rows):
                    yield emit(over.slice(at, out_rows), None)
                if (stay & alone).any():
                    due.append(ends[stay & alone].min())
            left = left.filter(pa.array(stay)) if stay.any() else None
            if left is not None:
                due.append(np.partition(ends[stay], stay.sum() // 2)[stay.sum() // 2])
        if right is not None:
            ends = times(right, right_time) - lower
            stay = ends > limit * 1000
            right = right.filter(pa.array(stay)) if stay.any() else None
            if right is not None:
                due.append(np.partition(ends[stay], stay.sum() // 2)[stay.sum() // 2])
        state.update((int(limit), keep(left, left_key), keep(right, right_key)))
        if due:         # fires when the watermark is past the timeout
            state.setTimeoutTimestamp(max(-(-int(min(due)) // 1000) - 1, int(limit), 1))

    return join


def _unpacker(schema):
    """The task's function: result blocks to rows, in the columns of ``schema`` (Arrow's)."""
    def unpack(batches):
        import pyarrow as pa

        for batch in batches:
            for block in batch.column("block"):
                for part in pa.ipc.open_stream(block.as_buffer()):
                    columns = [c.cast(f.type) for c, f in zip(part.columns, schema)]
                    columns += [pa.nulls(part.num_rows, f.type) for f in list(schema)[len(columns):]]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return unpack


def join_by_bucket(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_time: str, right_time: str,
                   lower: str, upper: str, how: str, salts: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """The join of ``interval_join`` on two streams (see ``can_keep_by_bucket``)."""
    salts = max(1, min(salts, buckets))
    whole = len(on) == 1 and isinstance(left.schema[on[0][0]].dataType, IntegralType)
    keys, extra = (on[0], []) if whole else ((_KEY, _KEY), [_KEY])      # a whole number is its own key
    packed = []
    for frame, place, time in ((left, 0, left_time), (right, 1, right_time)):
        names, columns = [pair[place] for pair in on], [_col(c) for c in frame.columns]
        key = _key(frame, names, [frame.schema[n].dataType for n in names])
        # a row without a key has no partner: a left one waits in any bucket, a right one only moves the watermark
        bucket = F.pmod(F.coalesce(F.when(key.isNotNull(), F.xxhash64(key)), F.xxhash64(*columns)), F.lit(buckets // salts)) * salts
        if salts > 1 and not place:     # a left row goes to one of its key's buckets, a right row to all
            bucket = bucket + F.pmod(F.xxhash64(*columns), F.lit(salts))
        rows = frame.select(*([] if whole else [key.alias(_KEY)]), *columns)
        schema = StructType([StructField("bucket", IntegerType()), StructField("is_left", BooleanType()),
                             StructField("at", TimestampType(), True, frame.schema[time].metadata),
                             StructField("block", BinaryType())])
        dealt = frame.filter(_col(time).isNotNull()).select(bucket.cast("int").alias(_BUCKET), *([] if whole else [key.alias(_KEY)]), *columns)
        packed.append(dealt.mapInArrow(
            _packer(time, keys[place], whole, not place, salts if place else 1, _PACK_ROWS, to_arrow_schema(rows.schema)), schema))
    joined = packed[0].unionAll(packed[1]).groupBy("bucket").applyInPandasWithState(
        _joiner(left_time, right_time, *keys, extra, whole, _micros(left, lower), _micros(left, upper), how == "left_outer", _OUT_ROWS),
        outputStructType="block binary", stateStructType=_STATE, outputMode="append", timeoutConf="EventTimeTimeout")
    out = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in [*left.schema.fields, *right.schema.fields]])
    return joined.mapInArrow(_unpacker(to_arrow_schema(out)), out)
