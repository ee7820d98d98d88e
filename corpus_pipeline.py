"""The corpus pipeline: toxicity, quality rules, near-duplicates, personal data,
packing.  Each stage takes ``(spark, docs, sf_dir)`` and its result is written and
read again as the next stage's documents; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import packing, pii, quality, simhash, toxicity
from tidemark.llm.common import Renamed, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    own = Renamed(docs)
    scored = toxicity.score(own.frame, model, text_col=own.of("text"), score_col="score")
    return own.back(scored.filter(F.col("score") < toxicity.THRESHOLD))


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, size=3, radius=2)


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, TOKENIZER, end_id=2, window=4096)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_bad),
    ("SimHash near-dedup", drop_copies),
    ("PII", hide_personal),
    ("packing", pack_windows),
]

ORACLE_SQL = None     # learned scores and connected components are not SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
