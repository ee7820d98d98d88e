"""The registered queries of the training-data operators: one per operator, over
its whole table with production settings, returning the contract's columns."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (alignment, article, bpe, licences, packing, pii, prefix_trie, quality, secret_scan, simhash, toxicity, warc,
               winnow)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_LEVEL = ("byte_level", public_tokenizers.path("byte_bpe_50k.json"))
PIECES = ("piece", public_tokenizers.path("piece_bpe_32k.model"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    pieces = packing.pack(docs, WORD_BPE, end_id=2, window=4096)
    return pieces.select("doc_id", "source", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, BYTE_BPE, public_tokenizers.PATTERN)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model).select("doc_id", "score")
    return scored.select("doc_id", (toxicity.remainder("doc_id") == 1).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = warc.write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read_archive(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, keep_text=False)
    of = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.listed(F.col("base_spans")), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


def op6_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return article.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "quality")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return winnow.compare_with_next(docs).select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, size=3, radius=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned, _ = alignment.align_corpus(docs, BYTE_LEVEL, PIECES, with_groups=False)
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs).withColumn("base", F.filter("spans", lambda s: s["base"]))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in secret_scan.KINDS],
                        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.paths(table(spark, sf_dir, "conversations"))
    nodes = prefix_trie.prefix_trie(prefix_trie.share_openings(own))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        "ends_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_pii": op5_pii,
    "op6_article": op6_article,
    "op7_quality": op7_quality,
    "op8_licences": op8_licences,
    "op9_winnowing": op9_winnowing,
    "op10_simhash": op10_simhash,
    "op11_alignment": op11_alignment,
    "op12_secrets": op12_secrets,
    "op13_prefix_trie": op13_prefix_trie,
}

# CRC-32 of a decimal id, bit by bit; h is its remainder by 4.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
  4294967295)"""

_TRIE_SQL = rf"""
WITH t AS (SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS p
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
h AS (SELECT c, p, ({_CRC} % 4)::BIGINT AS h FROM t),
f AS (SELECT h.c AS c, list_concat(coalesce(b.p[1:h.h], []), h.p[h.h + 1:]) AS p
      FROM h LEFT JOIN t b ON b.c = h.c - h.c % 20),
m AS (SELECT c, p, unnest(range(len(p) + 1)) AS d FROM f),
n AS (SELECT CASE WHEN d = 0 THEN [] ELSE p[1:d] END AS k, d, min(c) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(p) = d), '')) AS ends
      FROM m GROUP BY 1, 2),
w AS (SELECT *, CASE WHEN d = 0 THEN [] ELSE k[1:d - 1] END AS up,
             CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(k[d].x, '[^ 	-
]+')) END AS saved
      FROM n),
ch AS (SELECT up, count(*) AS n_children FROM w WHERE d > 0 GROUP BY 1),
g AS (SELECT w.*, coalesce(ch.n_children, 0) AS n_children FROM w LEFT JOIN ch ON ch.up = w.k),
a AS (SELECT saved, n_children, k, unnest(range(d + 1)) AS e FROM g),
s AS (SELECT CASE WHEN e = 0 THEN [] ELSE k[1:e] END AS k, sum(saved) AS saved_tokens,
             count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM a GROUP BY 1)
SELECT g.conv_id AS conv_id, g.d::BIGINT AS depth, CASE WHEN g.d > 0 THEN o.conv_id END AS parent_conv_id,
       g.n_convs::BIGINT AS n_convs, g.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, g.ends AS ends_sha256
FROM g JOIN s ON s.k = g.k JOIN g o ON o.k = g.up
"""

# SHA-1 in base 32: the 160 bits of the hex digest, five at a time.
_WARC_SQL = """
WITH d AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
b AS (SELECT page_id, h, octet_length(encode(h))::BIGINT AS payload_bytes, array_to_string(list_transform(string_split(sha1(h), ''),
  lambda c: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
            [strpos('0123456789abcdef', c)]), '') AS bits FROM d),
r AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM b)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
         + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
         + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM r
"""


def _rule_sql(rank: int, rule: secret_scan.Rule) -> str:
    """One rule's matches, by the texts between them: group 1 is what stands before the
    span (a look-behind as a character, or nothing), the last group what is measured."""
    before, body = "()", rule.pattern
    if body.startswith("(?<!["):
        cut = body.index("])") + 2
        before, body = f"(^|[^{body[5:cut - 2]}])", body[cut:]
    if rule.flags:                       # letters in either case, in ASCII only
        body = re.sub(r"(?<!\\)[a-z](?![^\[]*\])", lambda m: f"[{m[0]}{m[0].upper()}]", body)
    group = rule.part + 1 if rule.part else 0
    pattern = (before + body).replace("'", "''")
    return (f"SELECT n, '{rule.kind}' AS kind, {rank} AS rank, {str(rule.base).lower()} AS base, {rule.least} AS least, "
            f"regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', 1) AS g, "
            f"regexp_extract_all(t, '{pattern}', {group}) AS p, string_split_regex(t, '{pattern}') AS gaps FROM d")


_SECRETS_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_rule_sql(k, r) for k, r in enumerate(secret_scan.RULES))}),
i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM f),
s AS (SELECT n, kind, rank, base, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS pos, length(g[i]) AS skip, length(m[i]) AS size
      FROM i WHERE length(p[i]) >= least),
e AS (SELECT n, kind, rank, base, (pos + skip)::BIGINT AS start, kind || ':' || (pos + skip)::BIGINT || ':' || (pos + size)::BIGINT AS shown FROM s)
SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secret_scan.KINDS)},
       sha256(coalesce(string_agg(shown, ',' ORDER BY start, rank) FILTER (base), '')) AS base_sha256,
       coalesce(string_agg(shown, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN e USING (n) GROUP BY n, doc_id
"""

ORACLES: dict[str, str] = {"op4_warc": _WARC_SQL, "op12_secrets": _SECRETS_SQL, "op13_prefix_trie": _TRIE_SQL}
