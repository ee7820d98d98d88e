"""Change records built from a table: the offline stand-in for a CDC topic.

``change_feed(df, key=..., table=...)`` turns every row into one JSON change
record, keyed by the row's key (as text, like a Kafka message key).  The rule
for a row with integer key ``k``:

* ``op`` is the ``k mod 4``-th entry of ``ops`` (default c, u, d, r; ``r``, a
  snapshot read, stands for "any other code");
* ``before`` is set for ``u`` and ``d``, ``after`` for every op but ``d``;
  ``before_changes`` rewrites columns of the before image of an update, so
  picking the wrong image is visible;
* ``source`` is ``{"db": db, "table": table}``;
* ``ts_ms`` is the epoch milliseconds of ``ts_col`` (time-zone free for
  ``TIMESTAMP_NTZ``), or null.

Variants for tests: ``with_op=False`` drops ``op``; ``truncate_every=n`` makes
keys divisible by ``n`` a truncate with no image; ``malformed_every=n`` makes
them invalid text.  Every row of the input yields exactly one record.

Records are hash-partitioned by key, like a keyed CDC topic: all changes of a
key land in one partition.  That shuffle is only added when the table arrives
in fewer partitions than the cluster can run at once (e.g. one large row
group); a table already split that finely stays a narrow projection.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_OPS = ("c", "u", "d", "r")
MALFORMED_TEXT = "not a change record"

# to_json keeps explicit nulls (Debezium style) and full timestamp precision.
_JSON_OPTS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def epoch_millis(c: Column) -> Column:
    """Milliseconds since 1970-01-01 of a TIMESTAMP_NTZ (read as UTC); the
    difference of two NTZ values does not depend on the session time zone."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz"))


def spread_by_key(df: DataFrame, key: str, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition by ``key``: all changes of a key lie in one partition, in any
    number of input partitions."""
    target = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(target, F.col(f"`{key}`"))


def change_feed(df: DataFrame, *, key: str, table: str, db: str = "tpch",
                ts_col: str | None = None, ops: tuple[str, ...] = DEFAULT_OPS,
                before_changes: Mapping[str, Column] | None = None,
                with_op: bool = True, truncate_every: int | None = None,
                malformed_every: int | None = None,
                num_partitions: int | None = None) -> DataFrame:
    df = spread_by_key(df, key, num_partitions)
    k = F.col(f"`{key}`")
    cols = [F.col(f"`{c}`") for c in df.columns]
    op = F.element_at(F.array(*[F.lit(o) for o in ops]),
                      (F.pmod(k, F.lit(len(ops))) + 1).cast("int"))
    after = F.struct(*cols)
    changes = dict(before_changes or {})
    before_upd = F.struct(*[changes.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])
    before = (F.when(op == "u", before_upd)
               .when(op == "d", after))
    parts = [
        before.alias("before"),
        F.when(op != "d", after).alias("after"),
        F.struct(F.lit(db).alias("db"), F.lit(table).alias("table")).alias("source"),
    ]
    if with_op:
        parts.append(op.alias("op"))
    parts.append((epoch_millis(F.col(f"`{ts_col}`")) if ts_col else F.lit(None).cast("bigint")).alias("ts_ms"))
    record = F.to_json(F.struct(*parts), _JSON_OPTS)
    if truncate_every:
        trunc = F.to_json(F.struct(F.lit(None).cast("string").alias("before"),
                                   F.lit(None).cast("string").alias("after"),
                                   F.struct(F.lit(db).alias("db"), F.lit(table).alias("table")).alias("source"),
                                   F.lit("t").alias("op")), _JSON_OPTS)
        record = F.when(F.pmod(k, F.lit(truncate_every)) == 0, trunc).otherwise(record)
    if malformed_every:
        record = F.when(F.pmod(k, F.lit(malformed_every)) == 0, F.lit(MALFORMED_TEXT)).otherwise(record)
    return df.select(k.cast("string").alias("key"), record.alias("value"))
