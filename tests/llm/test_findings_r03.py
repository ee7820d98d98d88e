"""Cases of the third review: each fails on the code before it."""

from types import SimpleNamespace

import numpy as np
from helpers import plan_text
from tokenizers import Tokenizer

from tidemark.llm import licences, packing, queries, warc


def test_payloads_are_not_sorted(spark):
    rows = [(i, "u", "same" if i % 3 else f"own {i}") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = warc.deduplicated(pages)
        plan = plan_text(made, "simple")
        got = {r.page_id: r.refers_to for r in made.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    assert got == {i: 1 if i % 3 and i > 1 else None for i in range(30)}


def test_a_word_that_is_asked_for_again_is_not_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_PIECES", 40)
    enc, asked, tok = packing.WordEncoder(queries.WORD_BPE), [], Tokenizer.from_file(queries.WORD_BPE)
    whole = tok.model

    class Model:
        def tokenize(self, word):
            asked.append(word)
            return whole.tokenize(word)

    enc.tok = SimpleNamespace(model=Model(), encode=tok.encode)
    texts = [f"the sea\n word{chr(97 + i % 26)}{chr(97 + i // 26)}, the 'tis été {i} " for i in range(100)] + ["", " \n", "the"]
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
    assert asked.count("the") == 1
    assert enc.encode_all(texts) == [enc.encode(t) for t in texts]


def licence_lines(n):
    """Plain lines, each once, that share no word but ``of`` and ``the`` with a notice."""
    town = [a + b for a in ("kel", "mor", "tan", "vis", "dru", "pol", "hen", "sar") for b in ("by", "ford", "ham", "wick", "dale")]
    return [f"{town[i % 40]} {town[i // 40 % 40]} of the {town[i // 1600 % 40]} {town[(i * 7 + 3) % 40]}" for i in range(n)]


def test_licence_models_learn_from_every_paragraph(spark, monkeypatch):
    lines = licence_lines(6000)
    docs = spark.createDataFrame([(i, "\n".join(lines[i::60])) for i in range(60)], "doc_id long, text string")
    seen, fit, threshold_of = {}, licences.LogisticRegression.fit, licences.threshold_of

    def fitted(self, rows):
        unknown = rows.filter(rows.label == float(len(licences.TEMPLATES)))
        seen["fitted"] = unknown.count() - sum(f == licences.UNKNOWN and not held for f, _, held in licences.notices())
        seen["weight"] = unknown.groupBy().sum("weight").first()[0]
        return fit(self, rows)

    def calibrated(held):
        seen["held"] = held.count() - sum(f == licences.UNKNOWN and held for f, _, held in licences.notices())
        return threshold_of(held)

    monkeypatch.setattr(licences.LogisticRegression, "fit", fitted)
    monkeypatch.setattr(licences, "threshold_of", calibrated)
    assert licences.scan(docs).count() == 0
    assert seen["fitted"] + seen["held"] == 6000 and seen["held"] > 1000
    # the corpus weighs as 2,000 paragraphs would, and the seven sentences of our own as before
    assert abs(seen["weight"] - licences.UNKNOWN_WEIGHT * (licences.UNKNOWN_ROWS + 7)) < 1e-6


def test_the_licence_threshold_is_the_least_that_keeps_the_rate(spark):
    rng = np.random.default_rng(4)
    for many, top in ((3000, 0.9), (1000, 0.4), (5, 1.0), (0, 1.0)):
        p = sorted(float(x) for x in rng.random(many) * top)
        got = licences.threshold_of(spark.createDataFrame([(x,) for x in p], "probability double").repartition(3))
        allowed = licences.FALSE_RATE * many
        assert got >= licences.LEAST and sum(x >= got for x in p) <= allowed
        if got > licences.LEAST:
            assert sum(x >= got - 1 / licences.STEPS for x in p) > allowed
    assert licences.threshold_of(spark.createDataFrame([(1.0,)] * 4, "probability double")) > 1


def test_licence_lines_that_may_count_match_a_plain_share(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(8)
    known = {p for _, own in licences._templates() for p in own}
    some = [t.split() for ts in licences.TEMPLATES.values() for t in ts]
    lines = ["", "of", "the software", "of the of the of the of the town", "ab ab ab ab"]
    for _ in range(200):
        w = rng.choice(some)
        cut = w[rng.randrange(len(w)):][:rng.randrange(1, 9)] + rng.sample("a town by its river of the sea".split(), rng.randrange(6))
        lines.append(" ".join(cut * rng.randrange(1, 3)))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id for r in licences.paragraphs(docs, "doc_id", "text").filter(F.col("paragraph").isNotNull()).collect()}

    def counts(t):
        own = set(licences._pairs_of(t))
        return any(c in t.lower() for c in licences.CUES) or len(own & known) >= licences.CONFIRM * max(len(own), 1)

    assert got == {i for i, t in enumerate(lines) if counts(t)} and 0 < len(got) < len(lines)
