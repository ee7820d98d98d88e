"""Personal data by bootstrapped contextual extraction.

Base: e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone numbers, by
their written form, leftmost and non-overlapping per kind.

Bootstrapping: what the base finds are the seeds.  The two words before a seed are
a lexical pattern for its kind.  The same words also stand before other strings
that look like identifiers (words, or runs of digit groups as one); patterns and instances form a bipartite graph that
Spark scores in rounds: a pattern's confidence is the mean trust in the distinct
instances it meets (seeds of its kind count 1, of another kind 0), an instance's
trust is ``1 - prod(1 - confidence)`` over its other patterns, so that no pattern
vouches for itself.  Patterns that enough
distinct seeds support and that end with high confidence give their instances as
further spans.  Pairs are reduced to distinct (pattern, instance) before any
join, and patterns without support go first, so a frequent pattern is one row per
instance.

Rows: null and empty texts have no spans; repeated rows are found alike; an empty
table gives no rows; added columns replace columns of the same name.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField, StructType)

from .common import Renamed, cut, text_of, with_columns_from, written

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 5          # distinct seeds a pattern needs
CONFIDENCE = 0.9     # of a pattern whose instances are taken
ROUNDS = 4

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"\S+")
# Digit groups, bare or in brackets, parted by a space, hyphen or dot.
_GROUP = r"(?:\([0-9]++\)|\[[0-9]++\]|[0-9]++)"
_RUN = re.compile(rf"{_GROUP}(?:(?: - |[ \u00a0.-])?+{_GROUP})++")
LONGEST = 19         # digits of a run that is one identifier; of a longer one each word is
_TRIM = ".,;:!?\"'()[]{}<>*#$%&|=“”„’«»…"

SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()),
                   StructField("end", IntegerType())])
FOUND = StructType([StructField("kind", StringType()), StructField("start", IntegerType()),
                    StructField("end", IntegerType()), StructField("pattern", StringType()),
                    StructField("instance", StringType())])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str):
    at, past = text.find("@"), 0
    while at >= 0:
        start = at
        while start > past and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            past = m.end()
            at = text.find("@", past)
        else:
            # a later match may not reach back over this sign
            past = at + 1
            at = text.find("@", past)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by kind as listed, then by start (code points)."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if not any(c in text for c in "0123456789"):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def before(text: str, start: int) -> str:
    """The two words before a place, trimmed and in lower case; "" if there are not two.
    A word of more than 96 characters counts as pieces of 96, however wide the gaps are."""
    low = max(0, start - 96)
    words = text[low:start].split()
    if low and len(words) < 3:
        words = _two(text, start)
    if len(words) < 2:
        return ""
    pair = [w.strip(_TRIM).lower() for w in words[-2:]]
    return " ".join(pair) if all(pair) else ""


def _two(text: str, at: int) -> list[str]:
    out = []
    while len(out) < 2:
        while at and text[at - 1].isspace():
            at -= 1
        if not at:
            break
        end = at
        while at and end - at < 96 and not text[at - 1].isspace():
            at -= 1
        out.insert(0, text[at:end])
    return out


def runs(text: str, taken: list[tuple[int, int]]):
    """Digit groups of several words between the taken spans, each run one identifier."""
    at = 0
    for a, b in [*taken, (len(text), len(text))]:
        for m in _RUN.finditer(text, at, max(at, a)):
            s, e = m.span()
            if s and not (text[s - 1].isspace() or text[s - 1] in _TRIM):
                s = next((i + 1 for i in range(s, e) if text[i].isspace()), e)
            if e < len(text) and not (text[e].isspace() or text[e] in _TRIM):
                e = next((i for i in range(e - 1, s, -1) if text[i].isspace()), s)
            while s < e and text[e - 1] in " -\u00a0":
                e -= 1
            while s < e and text[s] in " -\u00a0":
                s += 1
            if (any(c.isspace() for c in text[s:e])
                    and 3 <= sum(c in "0123456789" for c in text[s:e]) <= LONGEST and e - s >= 5):
                yield s, e
        at = max(at, b)


def contexts(text: str) -> list[dict]:
    """Seeds (with kind) and other identifier-like strings (kind null), with the
    pattern each stands behind."""
    found = base_spans(text)
    rows = [{"kind": k, "start": s, "end": e, "pattern": before(text, s), "instance": text[s:e].lower()}
            for k, s, e in found]
    if not any(c in text for c in "0123456789@"):
        return rows
    taken = sorted((s, e) for _, s, e in found)
    whole = list(runs(text, taken))
    rows += [{"kind": None, "start": s, "end": e, "pattern": p, "instance": text[s:e].lower()}
             for s, e in whole if (p := before(text, s))]
    taken = sorted(taken + whole)
    at = 0
    for m in _WORD.finditer(text):
        raw = m[0]
        if not any(c in raw for c in "0123456789@"):
            continue
        s = m.start() + len(raw) - len(raw.lstrip(_TRIM))
        e = m.start() + len(raw.rstrip(_TRIM))
        if e - s < 5 or sum(c in "0123456789" for c in text[s:e]) < 3 and "@" not in text[s + 1:e - 1]:
            continue
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if any(a < e and s < b for a, b in taken[at:at + 4]):
            continue
        pattern = before(text, s)
        if pattern:
            rows.append({"kind": None, "start": s, "end": e, "pattern": pattern, "instance": text[s:e].lower()})
    return rows


def with_contexts(docs: DataFrame, text_col: str, keep_text: bool) -> DataFrame:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("pattern", pa.string()), ("instance", pa.string())]))

    def make():
        return lambda texts: (pa.array([contexts(t or "") for t in texts], kind),)

    return with_columns_from(docs, text_col, make, [StructField("tidemark_found", ArrayType(FOUND))],
                             drop=() if keep_text else (text_col,))


def accepted(rows: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE,
             rounds: int = ROUNDS) -> DataFrame:
    """``kind, pattern`` of the patterns to trust, from ``kind, pattern, instance``."""
    pairs = rows.filter("pattern <> ''").groupBy("pattern", "instance").agg(F.max("kind").alias("seed"))
    backed = (pairs.filter("seed is not null").groupBy("pattern", F.col("seed").alias("kind"))
              .agg(F.count(F.lit(1)).alias("seeds")).filter(F.col("seeds") >= support))
    graph = cut(pairs.join(backed.select("pattern", "kind"), "pattern"))
    seed = F.when(F.col("seed").isNull(), None).otherwise((F.col("seed") == F.col("kind")).cast("double"))
    mean = graph.groupBy("kind", "pattern").agg(F.avg(F.coalesce(seed, F.lit(0.0))).alias("conf"))
    doubt = F.log(F.greatest(F.lit(1e-9), 1 - F.col("conf")))
    for _ in range(rounds - 1):
        scored = graph.join(mean.withColumn("own", doubt).drop("conf"), ["kind", "pattern"])
        unseen = scored.filter("seed is null").groupBy("kind", "instance").agg(F.sum("own").alias("every"))
        others = 1 - F.exp(F.least(F.lit(0.0), F.col("every") - F.col("own")))    # 0 without another pattern
        mean = cut(scored.join(unseen, ["kind", "instance"], "left").groupBy("kind", "pattern")
                   .agg(F.avg(F.coalesce(seed, others, F.lit(0.0))).alias("conf")))
    return mean.filter(F.col("conf") >= confidence).select("kind", "pattern")


def find(docs: DataFrame, text_col: str = "text", spans_col: str = "spans", keep_text: bool = True,
         support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` (all: base and discovered), arrays of
    ``kind, start, end`` ordered by kind as listed, then start.  Other columns of any
    name stay; only those two names are replaced."""
    own = Renamed(docs)
    found = _find(own.frame, own.of(text_col), spans_col, keep_text, support, confidence, rounds)
    return own.back(found, ("base_spans", spans_col), () if keep_text else (text_col,))


def _find(docs: DataFrame, text_col: str, spans_col: str, keep_text: bool, support: int, confidence: float,
          rounds: int) -> DataFrame:
    rows = with_contexts(docs.withColumn(text_col, text_of(text_col)), text_col, keep_text)
    rows = written(rows.withColumn("tidemark_row", F.monotonically_increasing_id()), "pii")
    each = rows.select("tidemark_row", F.explode("tidemark_found").alias("f")).select("tidemark_row", "f.*")
    trusted = accepted(each.select("kind", "pattern", "instance"), support, confidence, rounds)
    more = (each.filter("kind is null").drop("kind").join(trusted, "pattern")
            .groupBy("tidemark_row", "start", "end").agg(F.min("kind").alias("kind"))
            .groupBy("tidemark_row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("tidemark_more")))
    base = F.transform(F.filter("tidemark_found", lambda f: f["kind"].isNotNull()),
                       lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")))
    order = F.array(*[F.lit(k) for k in KINDS])
    every = F.transform(
        F.sort_array(F.transform(
            F.concat(base, F.coalesce("tidemark_more", F.array().cast(ArrayType(SPAN)))),
            lambda s: F.struct(F.array_position(order, s["kind"]).alias("o"), s["start"].alias("start"),
                               s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    names = [c for c in docs.columns if keep_text or c != text_col]
    return (rows.join(more, "tidemark_row", "left")
            .select(*[F.col(f"`{c}`") for c in names], base.alias("base_spans"), every.alias(spans_col)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def hidden(text: str, spans) -> str:
    """``text`` with each span replaced by its kind; overlapping ones as one."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at:s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with all personal data in the texts replaced by its kind; a length
    column is brought up to date."""
    from pyspark.sql.pandas.types import to_arrow_schema

    from .common import slices

    own = Renamed(docs)
    text = own.of(text_col)
    found = find(own.frame, text, "spans").drop("base_spans")
    schema = StructType([StructField(f.name, StringType()) if f.name == text else f
                         for f in found.schema.fields if f.name != "spans"])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                new = [hidden(t, s) if s else t for t, s in
                       zip(part.column(text).to_pylist(), part.column("spans").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new, pa.string()) if n == text else part.column(n) for n in arrow.names],
                    names=arrow.names)

    out = found.mapInArrow(run, schema)
    if length_col and length_col in docs.columns:
        out = out.withColumn(own.of(length_col), F.length(text).cast(docs.schema[length_col].dataType))
    return own.back(out)
