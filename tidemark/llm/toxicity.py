"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and
skip-grams.

Features: presence of each word, each pair of neighbours, each pair with one word
between and the beginnings of words (``STARTS`` letters, so that a form not seen in
training is known by its stem), hashed to ``2 ** bits`` coordinates.  Training: FTRL-proximal with
per-coordinate learning rates; L1 keeps almost every weight at exactly zero, so
the model is a short list of (coordinate, weight) that is broadcast (at most
``2 ** bits`` weights, whatever the corpus).  It is fitted on about
``max_labels`` labelled rows of each class (a documented parameter; give or take the
chance of a hash: beyond it, a share of the ids by hash, so the choice is stable).  Scoring covers every whole
text in one pass without a shuffle.

Rows: a null or empty text has no features and scores by the bias; a null label
is no label; repeated labels of an id count once (toxic if any says so); without
any labelled row every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

import string
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField, StructType)

from .common import ship, text_of, with_columns_from

BITS = 20
MAX_LABELS = 6000     # of each class
EPOCHS = 8
ALPHA, BETA, L1, L2 = 3.0, 1.0, 8.0, 0.0
THRESHOLD = 0.7
STARTS = range(3, 9)
CACHED_WORDS = 300_000

_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_TRIM = string.punctuation + "“”„’‘«»…"


class Features:
    """Text -> sorted distinct coordinates."""

    def __init__(self, bits: int = BITS):
        from xxhash import xxh64_intdigest

        self.hash, self.known, self.starts = xxh64_intdigest, {}, {}
        self.shift = np.uint64(64 - bits)

    def _word(self, raw: str) -> int:
        w = raw.strip(_TRIM)
        got = self.hash(w.encode("utf-8", "surrogatepass")) if w else 0
        if len(raw) <= 64:
            self.known[raw] = got
        return got

    def _starts(self, raw: str) -> bytes:
        """Coordinates of the beginnings of a word that are shorter than it."""
        w, shift = raw.strip(_TRIM), int(self.shift)
        at = [self.hash(b"\0" + w[:n].encode("utf-8", "surrogatepass")) >> shift for n in STARTS if n < len(w)]
        got = struct.pack(f"<{len(at)}i", *at)
        if len(raw) <= 64:
            self.starts[raw] = got
        return got

    def __call__(self, text: str) -> np.ndarray:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
            self.starts.clear()
        words = text.lower().split()
        get, out = self.known.get, []
        for raw in words:
            got = get(raw)
            out.append(self._word(raw) if got is None else got)
        h = np.array(out, np.uint64)
        h = h[h != 0]
        if not len(h):
            return np.zeros(0, np.int32)
        with np.errstate(over="ignore"):
            one = h
            two = (h[:-1] * _PAIR) ^ (h[1:] + _PAIR)
            skip = (h[:-2] * _SKIP) ^ (h[2:] + _SKIP)
            mixed = np.concatenate([one, two * _PAIR, skip * _SKIP])
        get, starts = self.starts.get, []
        for raw in set(words):
            got = get(raw)
            starts.append(self._starts(raw) if got is None else got)
        return np.unique(np.concatenate([(mixed >> self.shift).astype(np.int32),
                                         np.frombuffer(b"".join(starts), "<i4")]))


class Ftrl:
    """FTRL-proximal with per-coordinate rates; the bias has neither L1 nor L2."""

    def __init__(self, bits: int = BITS, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z = np.zeros(1 << bits)
        self.n = np.zeros(1 << bits)
        self.zb = self.nb = 0.0
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    @property
    def bias(self) -> float:
        return -self.zb / ((self.beta + self.nb ** 0.5) / self.alpha)

    def learn(self, at: np.ndarray, label: int) -> None:
        w, b = self.weights(at), self.bias
        p = float(sigmoid(w.sum() + b))
        g = p - label
        s = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - s * w
        self.n[at] += g * g
        sb = ((self.nb + g * g) ** 0.5 - self.nb ** 0.5) / self.alpha
        self.zb += g - sb * b
        self.nb += g * g


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, mod 3; 1 is held out."""
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(3))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", bits: int = BITS, max_labels: int = MAX_LABELS,
        epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """Nonzero weights ``(coordinates, weights, bias)`` from labelled rows that are
    not held out."""
    spark = docs.sparkSession
    ship(spark)
    usable = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
              .filter("label in (0, 1) and id is not null").groupBy("id").agg(F.max("label").alias("label"))
              .filter(remainder("id") != 1))
    sizes = {r.label: r.n for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    wide = 1 << 20            # a share of each class by hash: about max_labels rows of 12 bytes, broadcast
    share = F.create_map(*[F.lit(x) for c, n in {0: 1, 1: 1, **sizes}.items()
                           for x in (c, min(wide, wide * max_labels // n))])
    chosen = usable.filter(F.pmod(F.xxhash64("id"), F.lit(wide)) < share[F.col("label")])
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
            .join(F.broadcast(chosen), "id"))
    rows = with_columns_from(rows, "text", lambda: _featurise(bits),
                             [StructField("at", ArrayType(IntegerType(), False))], drop=("text",))
    out = StructType([StructField("at", IntegerType()), StructField("weight", DoubleType())])

    def train(batches):
        model, rows = Ftrl(bits), []
        for batch in batches:
            at = batch.column("at")
            flat, ends = at.flatten().to_numpy(zero_copy_only=False), at.offsets.to_numpy()
            base = ends[0]
            rows += [(flat[s - base:e - base].copy(), y) for s, e, y in
                     zip(ends[:-1], ends[1:], batch.column("label").to_pylist())]
        for _ in range(epochs):
            for at, y in rows:
                model.learn(at, y)
        w = model.weights(slice(None))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)),
                                          pa.array(np.append(w[at], model.bias))], names=["at", "weight"])

    order = rows.select("at", "label", F.xxhash64("id", F.lit(7)).alias("o"), "id").repartition(1) \
        .sortWithinPartitions("o", "id")
    got = order.select("at", "label").mapInArrow(train, out).toPandas()
    bias = got.loc[got["at"] < 0, "weight"]
    w = got[got["at"] >= 0]
    return (w["at"].to_numpy(np.int32), w["weight"].to_numpy(np.float64),
            float(bias.iloc[0]) if len(bias) else 0.0)


def _featurise(bits: int):
    features = Features(bits)

    def f(texts):
        got = [features(t) for t in texts]
        ends = np.cumsum([0] + [len(g) for g in got])
        flat = np.concatenate(got) if got else np.zeros(0, np.int32)
        return (pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()),
                                         type=pa.list_(pa.field("element", pa.int32(), False))),)
    return f


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text_col: str = "text",
          score_col: str = "score", bits: int = BITS) -> DataFrame:
    """``docs`` with the probability that a text is toxic."""
    at, weights, bias = model
    sent = docs.sparkSession.sparkContext.broadcast((at, weights, bias))

    def make():
        at, weights, bias = sent.value
        table = np.zeros(1 << bits)
        table[at] = weights
        features = Features(bits)

        def f(texts):
            got = (features(t or "") for t in texts)
            return (pa.array([float(sigmoid(table[g].sum() + bias)) for g in got], pa.float64()),)
        return f

    return with_columns_from(docs, text_col, make, [StructField(score_col, DoubleType())])
