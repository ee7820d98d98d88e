"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by its content (SHA-256 of the text: the
blob).  The ledger, a Parquet table that only grows, says which rules, each with its
version, have seen which blob, and what they found there.  A scan reads the ledger,
takes the (blob, rule version) pairs that are not in it, runs just those rules over
one copy of each such blob, appends what it learnt, and joins the findings of all
blobs back to every path that holds them.  So a blob that a thousand paths share, or
that an earlier scan has seen, is not scanned again, and a new version of one rule
scans the old blobs for that rule alone.

Spark: copies are reduced to one text per blob before the shuffle (and again after
it); the ledger meets the blobs by their digests.  Findings go back on (blob, salt),
so that the paths of one very common blob are dealt out; blobs without findings are
not joined at all.  An append is one Spark write: a lost executor's task is run again
and a failed scan leaves the ledger as it was.  Two scans that learn the same pair
write it twice, which changes nothing.

Rules are regular expressions over whole texts, leftmost and non-overlapping; a match
that a rule's check turns down is dropped.  ``base`` rules are the contract's, the
others add spans of well-known formats.

Rows: a null text is an empty one; a null path keeps its row; repeated rows get the
same spans each; an empty table gives no rows.  Added columns (``blob``, ``spans``)
replace columns of the same name (case aside).  Offsets are code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, LongType, StringType, StructField, StructType)

from .common import SLICE_BYTES, as_one, shared_folder, ship, slices, text_of
from ..session import remove_at_end

SALTS = 32          # parts that the paths of one blob are dealt into


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    flags: int = 0
    least: int = 0          # characters the match (or its group ``part``) must have
    part: int = 0
    base: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def find(self) -> Callable[[str], list[tuple[int, int]]]:
        finditer, least, part = re.compile(self.pattern, self.flags).finditer, self.least, self.part

        def spans(text: str) -> list[tuple[int, int]]:
            return [m.span() for m in finditer(text) if m.end(part) - m.start(part) >= least]
        return spans


# The contract's base patterns and lengths.  (Of a hex run or an access
# id a match is the whole run, so the length may stand in the pattern.)
BASE_RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.IGNORECASE | re.ASCII, least=6, part=2, base=True),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", 1, r"[0-9a-f]{24,}", base=True),
)
# Public formats of credentials, each with a mark of its own.
FORMAT_RULES = (
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY(?: BLOCK)?-----"),
    Rule("code_host_token", 1, r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", 1, r"(?<![A-Za-z0-9-])xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", 1, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_password", 1, r"(?:https?|ftps?|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\s/:@]{1,256}:[^\s/@]{1,256}@"),
)
RULES = BASE_RULES + FORMAT_RULES
KINDS = tuple(r.kind for r in BASE_RULES)

_SPAN = StructType([StructField("rule", StringType()), StructField("start", LongType()), StructField("end", LongType())])
LEDGER = StructType([StructField("blob", BinaryType()), StructField("rules", ArrayType(StringType())),
                     StructField("spans", ArrayType(_SPAN))])


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per blob: every rule version that has seen it, and what they found.
    None while no scan has written there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    runs = spark.read.schema(LEDGER).parquet(path)
    return runs.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"),
                                    F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))


def unseen(blobs: DataFrame, ledger: DataFrame | None, rules: Sequence[Rule]) -> DataFrame:
    """``blobs`` (with a column ``blob``) that some rule version has not seen, with those."""
    wanted = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        return blobs.withColumn("todo", wanted)
    seen = ledger.select("blob", F.col("rules").alias("seen"))
    return (blobs.join(seen, "blob", "left")
            .withColumn("todo", F.when(F.col("seen").isNull(), wanted).otherwise(F.array_except(wanted, "seen")))
            .filter(F.size("todo") > 0).drop("seen"))


def _scanner(rules: tuple[Rule, ...]) -> Callable:
    def run(batches):
        find = {r.name: r.find() for r in rules}
        span = pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                todo = part.column("todo").to_pylist()
                found = [[{"rule": name, "start": s, "end": e} for name in names for s, e in find[name](text)]
                         for text, names in zip(part.column("text").to_pylist(), todo)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("blob").cast(pa.binary()), pa.array(todo, pa.list_(pa.string())),
                     pa.array(found, pa.list_(span))], names=["blob", "rules", "spans"])
    return run


def scan(versions: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = RULES,
         text_col: str = "text") -> DataFrame:
    """``versions`` (any columns beside the text, which is left out) with ``blob`` (hex
    digest) and ``spans`` (``kind, start, end, base``, by start, then rule order).
    ``ledger`` is a folder in shared storage; without one, a fresh ledger of this
    application is used and goes with it."""
    spark = versions.sparkSession
    if len({r.kind for r in rules}) != len(rules):
        raise ValueError("a kind may have one version at a time")
    ship(spark)
    if ledger is None:
        import uuid

        ledger = f"{shared_folder(spark)}/tidemark/llm/ledger-{uuid.uuid4().hex}"
        remove_at_end(spark, ledger)
    others = [c for c in versions.columns if c.lower() not in ("blob", "spans", text_col.lower())]
    rows = versions.select(as_one(others).alias("row"),
                           text_of(text_col).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2(F.col("text"), 256)))
    blobs = rows.groupBy("blob").agg(F.first("text").alias("text"))
    todo = unseen(blobs, read_ledger(spark, ledger), rules)
    todo.select("blob", "text", "todo").mapInArrow(_scanner(tuple(rules)), LEDGER) \
        .write.mode("append").parquet(ledger)

    order = {r.name: (k, r.kind, r.base) for k, r in enumerate(rules)}
    kinds = F.array(*[F.lit(r.name) for r in rules])
    plain = F.transform(F.filter("spans", lambda s: s["rule"].isin(list(order))), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(kinds, s["rule"]).alias("rank"), s["end"].alias("end")))
    names = F.array(*[F.lit(r.kind) for r in rules])
    base = F.array(*[F.lit(r.base) for r in rules])
    spans = F.transform(F.array_sort(plain), lambda s: F.struct(
        F.element_at(names, s["rank"].cast("int")).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.element_at(base, s["rank"].cast("int")).alias("base")))
    found = (read_ledger(spark, ledger).withColumn("spans", spans).filter(F.size("spans") > 0)
             .select("blob", "spans", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    # from the row's own values, so that it is the same when a lost task runs again (maps have no hash)
    own = [F.col("row").getField(c) for c in others if "map<" not in versions.schema[c].dataType.simpleString()]
    salt = F.pmod(F.xxhash64(F.lit(SALTS), *own), F.lit(SALTS)).cast("int").alias("salt")
    none = F.array().cast(found.schema["spans"].dataType)
    return (rows.select("row", "blob", salt).join(found, ["blob", "salt"], "left")
            .select(*[F.col("row").getField(c).alias(c) for c in others], F.lower(F.hex("blob")).alias("blob"),
                    F.coalesce("spans", none).alias("spans")))
