"""Each training-data operator against a plain computation of the same result."""

import base64
import hashlib
import io
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tidemark.llm import article, bpe, packing, pii, quality, queries, simhash, toxicity, warc, winnow


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def test_packing_matches_the_library_and_fills_windows(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.WORD_BPE)
    ids = {k: np.array(tok.encode(t, add_special_tokens=False).ids + [2], "<u4") for k, t in docs.items()}
    got = queries.op1_packing(spark, SF_SMALL).toPandas()
    assert set(got.doc_id) == set(docs)
    for k, g in got.sort_values("start").groupby("doc_id"):
        at = 0
        for x in g.itertuples():
            assert x.start == at and x.doc_tokens == len(ids[k])
            at += x.length
            assert zlib.crc32(ids[k][x.start:at].tobytes()) == x.ids_crc32
        assert at == len(ids[k])
    last = got.sequence_id.max()
    total = got.groupby("source").length.sum()
    share = total / total.sum()
    for w, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.values == np.cumsum(g.length.values) - g.length.values).all()
        if w < last:
            assert g.length.sum() == 4096
            held = g.groupby("source").length.sum().reindex(share.index, fill_value=0)
            assert (abs(held - share * 4096) <= 2).all()      # target proportions in every window


@pytest.mark.parametrize("totals,shares", [([50, 7, 400], [50, 7, 400]), ([50, 7, 400], [1, 1, 1]), ([3], [1]),
                                           ([1, 1, 1, 1], [1, 1, 1, 1]), ([1000, 1], [1, 1e-6])])
def test_schedule_is_the_token_by_token_round_robin(totals, shares):
    plan = packing.Schedule(totals, shares)
    order = sorted(((j + 0.5) / plan.p[s], s) for s, n in enumerate(totals) for j in range(n))
    sent = [0] * len(totals)
    every = plan.sent(np.arange(sum(totals) + 2))
    for t, (_, s) in enumerate(order):
        assert every[t].tolist() == sent
        sent[s] += 1
    assert every[-1].tolist() == totals


@pytest.mark.parametrize("cells", [1, 40, 1 << 20])
def test_pieces_do_not_depend_on_the_table_of_edges(spark, cells):
    """Sources that lie apart in the input, one very rare, with tables of few windows."""
    sizes = {"a": [90] * 30, "b": [7, 1, 40, 3], "c": [400, 2, 300]}
    window, totals = 16, [(q, sum(n)) for q, n in sizes.items()]
    rows, ids = [], {}
    for q, lengths in sizes.items():
        at = 0
        for n in lengths:
            doc = len(ids)
            ids[doc] = np.arange(doc * 1000, doc * 1000 + n, dtype="<u4")
            rows.append((doc, q, bytearray(ids[doc].tobytes()), at))
            at += n
    df = spark.createDataFrame(rows, "doc_id long, queue string, ids binary, start long").coalesce(1)
    got = packing.cut_pieces(df, totals, None, window, cells).toPandas()
    plan = packing.Schedule([n for _, n in totals], [n for _, n in totals])
    names = [q for q, _ in totals]
    order = sorted(((j + 0.5) / plan.p[s], s) for s, (_, n) in enumerate(totals) for j in range(n))
    queued = {q: iter(np.concatenate([ids[d] for d, p, _, _ in rows if p == q])) for q in names}
    stream = np.array([next(queued[names[s]]) for _, s in order], "<u4")
    seen = {d: 0 for d in ids}
    for x in got.sort_values(["doc_id", "start"]).itertuples():
        assert x.start == seen[x.doc_id] and x.doc_tokens == len(ids[x.doc_id])
        seen[x.doc_id] += x.length
        assert bytes(x.ids) == ids[x.doc_id][x.start:x.start + x.length].tobytes()
    assert seen == {d: len(v) for d, v in ids.items()}
    for w, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.values == np.cumsum(g.length.values) - g.length.values).all()
        held = np.concatenate([np.frombuffer(bytes(x), "<u4") for x in g.ids])
        assert sorted(held) == sorted(stream[w * window:(w + 1) * window])


def test_packing_follows_stated_targets(spark):
    rows = [(i, "word " * 200, "a" if i % 4 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = packing.pack(df, queries.WORD_BPE, window=256, targets={"a": 0.5, "b": 0.5}).toPandas()
    assert got.length.sum() == 400 * 201
    early = got[got.sequence_id < 100].groupby(["sequence_id", "source"]).length.sum()
    assert (abs(early - 128) <= 1).all()


def _library():
    import tiktoken

    with open(queries.BYTE_BPE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_matches_the_library(spark, docs):
    enc = _library()
    for x in queries.op2_byte_bpe(spark, SF_SMALL).collect():
        ids = np.array(enc.encode_ordinary(docs[x.doc_id]), "<u4")
        assert x.n_tokens == len(ids) and x.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(docs[x.doc_id].encode()).hexdigest()


def test_encoders_on_odd_strings():
    from tokenizers import Tokenizer

    enc, own = _library(), bpe.byte_encoder(queries.BYTE_BPE, P.PATTERN)
    tok = Tokenizer.from_file(queries.WORD_BPE)
    words = packing.word_encoder(queries.WORD_BPE)
    rng = random.Random(5)
    letters = "ab cdeÉÄ\n  \t'éß1923.,!?s' tll　中文😀\x1c\x85\xa0\xadİΣ́<|endoftext|>"
    for _ in range(1500):
        t = "".join(rng.choice(letters[:rng.choice([14, 25, len(letters)])]) for _ in range(rng.randint(0, 50)))
        assert np.frombuffer(own.encode(t), "<u4").tolist() == enc.encode_ordinary(t), repr(t)
        assert own.decode(own.encode(t)).decode() == t
        assert np.frombuffer(words.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    for t in ("a b <|endoftext|> c", "x<|startoftext|>y", "<|ENDOFTEXT|>", "a <|endof text|>", "<|endoftext|><|endoftext|>\n"):
        assert np.frombuffer(words.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    assert 49407 in tok.encode("a b <|endoftext|> c", add_special_tokens=False).ids
    long = "aaaaabbbabababaab" * 2000          # one pre-token of 34,000 bytes
    assert np.frombuffer(own.encode(long), "<u4").tolist() == enc.encode_ordinary(long)


def test_merge_order_and_stale_entries():
    # "ab" + "c" gives a token of lower rank than "ab": it goes before the waiting "ab"s
    ranks = {bytes([c]): i + 10 for i, c in enumerate(b"abcx")} | {b"ab": 5, b"abc": 3, b"abcab": 7}
    marks = bpe.rank_words(20)

    def plain(piece):
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(2)
    for _ in range(500):
        piece = bytes(rng.choice(b"abcx") for _ in range(rng.randint(1, 30)))
        assert bpe.merge(piece, ranks, marks) == plain(piece)
        assert not any(marks)


def test_toxicity_learns_and_holds_out(spark):
    d = "/root/testdata/sf0.1"
    got = queries.op3_toxicity(spark, d).toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    labels = spark.read.parquet(f"{d}/labels.parquet").toPandas()
    held = got.merge(labels, on="doc_id").query("held_out")
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert (clean.predicted == 0).mean() > 0.99
    pairs = toxic.score.values[:, None] - clean.score.values[None, :]
    assert (pairs > 0).mean() + (pairs == 0).mean() / 2 > 0.95


def test_unseen_forms_of_a_word_are_known_by_its_beginning(spark):
    ends = [a + b for a in "kmprt" for b in ("ol", "en", "ist", "ung", "ade", "ibel")]
    rows = [(i, f"all of this is plain {'grumbl' if i % 2 else 'meadow'}{ends[i // 2 % 24]} text", i % 2) for i in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    new = spark.createDataFrame([(i, f"all of this is plain {w}{e} text", w == "grumbl")
                                 for i, (w, e) in enumerate((w, e) for w in ("grumbl", "meadow") for e in ends[24:])],
                                "doc_id long, text string, toxic boolean")
    for r in toxicity.score(new, model).collect():
        assert (r.score >= toxicity.THRESHOLD) == r.toxic


def test_held_out_labels_never_reach_the_model(spark):
    d = SF_SMALL
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.remainder("doc_id") == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]) and a[2] == b[2]


def test_warc_round_trip_and_seeking(spark):
    import zstandard

    base = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").limit(40)
    extra = spark.createDataFrame([(5000, None, None), (5001, "a b\n", ""), (None, "x", None)], base.schema)
    pages = base.unionAll(base.limit(10).withColumn("page_id", F.col("page_id") + 1000)).unionAll(extra)
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    first = {}
    for i, b in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(b, i)
    bundles = warc.write_archive(pages, frame_bytes=20_000)
    got = {r.page_id: r for r in warc.read_archive(bundles).collect()}
    assert len(got) == len(rows)
    for i, b in rows:
        r = got[i]
        assert r.payload_bytes == len(b)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(b).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if first[b] == i else ("revisit", first[b]))
    ids = spark.createDataFrame([(5001,), (1000 + rows[0][0],)], "page_id long")
    some = {r.page_id: r for r in warc.read_records(bundles, ids).collect()}
    assert some[5001].refers_to == 5000 and len(some) == 2
    for name in [r.bundle for r in bundles.select("bundle").distinct().collect()]:
        whole = warc.bundle_file(bundles, name)
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(whole), read_across_frames=True).read()
        table = warc.read_seek_table(whole)
        assert sum(size for _, _, size in table) == len(raw)
        for at, packed, size in table:
            assert len(zstandard.ZstdDecompressor().decompress(whole[at:at + packed])) == size
        assert next(warc.split_records(raw))[1]["WARC-Type"] == "warcinfo"
    at = warc.index(bundles).filter("page_id = 5000").first()
    whole = warc.bundle_file(bundles, at.bundle)
    start, packed, _ = warc.read_seek_table(whole)[at.frame]
    record = zstandard.ZstdDecompressor().decompress(whole[start:start + packed])[at.offset:at.offset + at.length]
    assert b"<urn:page:5000>" in record
    assert warc.index(bundles).count() == len(rows) and warc.index(bundles).agg(F.max("frame")).first()[0] > 0
    # a wrong index or seek table is noticed
    moved = bundles.withColumn("records", F.transform("records", lambda r: r.withField("page_id", F.coalesce(r["page_id"], F.lit(0)) + 1)))
    with pytest.raises(Exception, match="the index says"):
        warc.read_archive(moved).collect()


def plain_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in re.sub(r"\D", "", m[0])[::-1]]
        if 16 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_match_the_patterns(spark, docs):
    rng = random.Random(3)
    for letters in ("ab.@@-_+1 23.4()%é\n", "12.+ -(", "4111 -"):
        for _ in range(4000):
            t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 45)))
            assert pii.base_spans(t) == plain_spans(t), repr(t)
    for x in queries.op5_pii(spark, SF_SMALL).collect():
        base = plain_spans(docs[x.doc_id])
        shown = [f"{k}:{a}:{b}" for k, a, b in base]
        assert x.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest()
        count = Counter(k for k, _, _ in base)
        assert (x.n_email, x.n_ip, x.n_card, x.n_phone) == tuple(count[k] for k in pii.KINDS)
        assert set(shown) <= set(x.spans.split(",") if x.spans else [])


def test_contexts_find_unseen_identifiers_and_nothing_else(spark):
    texts = [f"Please note my phone number: +1 (555) 010-{1000 + i} thanks." for i in range(12)]
    texts += ["Please note my phone number: 555-0199 thanks.", "The part has 12345-678 on its side.",
              "number of words 2024-01 here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(df).collect()}
    assert [(s.kind, texts[12][s.start:s.end]) for s in got[12].spans] == [("phone", "555-0199")]
    assert not got[12].base_spans and not got[13].spans and not got[14].spans
    hidden = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert hidden[12] == "Please note my phone number: <PHONE> thanks." and hidden[13] == texts[13]


def test_article_text(spark):
    import html as H

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    for x in queries.op6_article(spark, SF_SMALL).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[x.page_id], re.S)[1]
        blocks = [" ".join(H.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert x.text == "\n".join(b for b in blocks if b) and x.n_chars == len(x.text)


@pytest.mark.parametrize("page,text", [
    ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<" * 5, "<" * 5), ("<a href='x", ""),
    ("<body><div class='sidebar'>xx</div>hello <b>w</b>orld<br>next</body>", "hello world next"),
    ("<div><div id=comments><p>no</p></div><section><p>yes one two three</p></section>"
     "<section><p>also yes indeed</p></section></div>", "yes one two three\nalso yes indeed"),
    ("<article><h1>T</h1><p>para <a href=x>link</a> &nbsp; &lt;b&gt;</p><ul><li>i1<li>i2</ul></article>"
     "<div class='user-comments'><p>" + "c " * 500 + "</p></div>", "T\npara link <b>\ni1\ni2"),
    ("</p></div>x<script>if(a<b){}</script>y<!-- z", "xy"),
    ("<body class='with-sidebar'><form><p>sign up</p></form><p>text stays</p></body>", "text stays"),
])
def test_article_of_odd_pages(page, text):
    assert article.main_text(page) == text


def test_deep_page_does_not_fail():
    assert article.main_text("<div>" * 20_000 + "<p>deep text</p>") == "deep text"


@pytest.mark.parametrize("page", ["<span>a" * 30_000 + "</b>" * 30_000, "<b>" + "<div>a" * 30_000 + "</b>" * 30_000,
                                  "<span>a" * 30_000 + "<li>b" * 30_000, "<div>a<article>b" * 30_000])
def test_deep_pages_take_linear_time(page):
    started = time.process_time()
    assert article.main_text(page).startswith(("a", "b"))
    assert time.process_time() - started < 20


def plain_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup, covered = set(), 0, set()
    times = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    for i in range(len(w) - 4):
        if times[tuple(w[i:i + 5])] > 1:
            covered |= set(range(i, i + 5))
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_quality_counts_and_verdicts(spark, docs):
    rng = random.Random(4)
    odd = {-i: "".join(rng.choice(["a ", "b ", "a b c d e ", "x\n", "\n", "\t", "é# ", "  ", "\x0b"]) for _ in range(rng.randint(0, 60)))
           for i in range(1, 200)}
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").unionAll(
        spark.createDataFrame(list(odd.items()), "doc_id long, text string"))
    for x in quality.judge(df).collect():
        want = plain_counts(docs.get(x.doc_id, odd.get(x.doc_id)))
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (x.kept and x.base_failed) and (x.kept == (x.quality >= 0.5 and not x.base_failed))


def test_quality_agrees_with_labels(spark):
    d = "/root/testdata/sf0.1"
    got = queries.op7_quality(spark, d).select("doc_id", "kept", "base_failed").toPandas()
    labels = spark.read.parquet(f"{d}/labels.parquet").toPandas()
    m = got.merge(labels, on="doc_id")
    good, bad = m[(m.quality == 1) & ~m.base_failed], m[m.quality == 0]
    assert good.kept.mean() > 0.98 and bad.kept.mean() < 0.05


def test_votes_move_the_posterior():
    clean, spoilt = (0, 0, quality.GOOD), (quality.BAD, 0, quality.GOOD)
    start, table = quality.estimate([(clean, 950), (spoilt, 50)])
    odds = {v: start + sum(quality.gain(table[j], x) for j, x in enumerate(v)) for v in (clean, spoilt)}
    assert odds[clean] > 0 > odds[spoilt]
    start, table = quality.estimate([(clean, 1000)])          # no bad texts: all are kept
    assert start + quality.gain(table[2], quality.GOOD) > 0
    assert quality.estimate([])[1] == []


def test_licences_are_found(spark):
    from tidemark.llm import licences

    lines = {"mit": "Released under the MIT License.", "apache": "Licensed under the Apache License, Version 2.0.",
             "gpl": "This work is licensed under the GNU General Public License, version 3.",
             "cc_by_nc": "Licensed under CC BY-NC 4.0.", "unknown": "My driving license was lost in the rain."}
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    plain = base.filter(~F.lower("text").rlike("licen|copyright|rights"))
    own = spark.createDataFrame([(-i - 1, f"Some words here.\n{t}") for i, t in enumerate(lines.values())], base.schema)
    got = {r.doc_id: r for r in licences.scan(plain.unionAll(own)).collect() if r.doc_id < 0}
    assert [got[-i - 1].family for i in range(len(lines))] == list(lines)
    assert all(r.line == 1 for r in got.values())


def test_wrapped_licence_lines_without_a_cue_word_are_scored(spark):
    """Lines of a wrapped licence text: whatever a plain comparison confirms has a row."""
    import re

    from tidemark.llm import licences

    texts = ["free of charge, to any person obtaining a copy of this software and", "associated documentation files, to deal in",
             "The cat sat on the mat, and the dog on the rug.", "Public License as published by the Free Software Foundation.",
             "and binary forms, with or without modification, are permitted provided that", "", "of any kind"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")

    def plain(t):
        w = re.findall(r"[^\W\d_]+|0", re.sub("[0-9]+", "0", t.lower()))
        return set(zip(w, w[1:]))

    best = {i: max((len(plain(t) & plain(x)) / max(len(plain(t)), 1)) for ts in licences.TEMPLATES.values() for x in ts)
            for i, t in enumerate(texts)}
    got = {r.doc_id: r for r in licences.scan(df).collect()}
    assert {i for i, b in best.items() if b >= licences.CONFIRM} <= set(got)
    assert got[0].family == "mit" and got[4].family == "bsd"
    assert 2 not in got and 5 not in got
    assert all(r.similarity <= best[i] + 1e-9 for i, r in got.items())


def plain_winnow(t, k=winnow.GRAM, w=winnow.WINDOW):
    h = winnow.gram_hashes(t, k).tolist()
    w, out = min(w, len(h)), []
    for i in range(len(h) - w + 1 if h else 0):
        least = min(h[i:i + w])
        at = max(j for j in range(i, i + w) if h[j] == least)
        if not out or out[-1] != (least, at):
            out.append((least, at))
    return ",".join(f"{a:08x}@{b}" for a, b in out)


def test_winnowing(spark, docs):
    ids = sorted(docs, reverse=True)
    got = {r.doc_id: r for r in queries.op9_winnowing(spark, SF_SMALL).collect()}
    assert set(got) == set(ids)
    for i, k in enumerate(ids):
        t, after = docs[k], docs[ids[(i + 1) % len(ids)]]
        m = len(t) // 3
        new = t[:len(t) - m] + after[:m]
        x = got[k]
        assert x.n_chars == len(t) and x.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        if i % 10 == 0:
            assert x.fingerprint == plain_winnow(t) and x.edited_fingerprint == plain_winnow(new)
            one, two, three = ({h.split("@")[0] for h in f.split(",") if h} for f in
                               (plain_winnow(t), plain_winnow(new), plain_winnow(after)))
            like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
            assert x.near_edited == like(one, two) and x.near_next == like(one, three)


def test_winnowing_ties_and_guarantee():
    assert winnow.shown(winnow.winnowed("a" * 300)) == plain_winnow("a" * 300)    # rightmost of equal hashes
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(50):
        shared = word(winnow.GRAM + winnow.WINDOW - 1)
        a, b = word(rng.randint(0, 400)) + shared + word(200), word(rng.randint(0, 400)) + shared + word(100)
        assert set((winnow.winnowed(a) >> np.uint64(32)).tolist()) & set((winnow.winnowed(b) >> np.uint64(32)).tolist())
    for k in range(1, 40):          # the rolling hash is the same wherever a gram stands
        t = word(200)
        assert winnow.gram_hashes("xyz" + t, k)[3:].tolist() == winnow.gram_hashes(t, k).tolist()


def test_many_ranges_are_followed_in_order(spark):
    rows = [(i * 7, f"text number {i} " * (i % 5 + 1)) for i in range(60)] + [(None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r for r in winnow.compare_with_next(df, ranges=25).collect()}
    order = sorted([i for i, _ in rows if i is not None], reverse=True) + [None]
    texts = dict(rows)
    for a, b in zip(order, order[1:] + order[:1]):
        assert got[a].edited_text == winnow.edited(texts[a], texts[b])


def roots(prints, radius=2):
    up = {k: k for k in prints}

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    keys = list(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_simhash_matches_brute_force(spark, docs):
    import xxhash

    prints = {}
    for k, t in docs.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), t.encode()))
        parts = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        prints[k] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    want = roots(prints)
    got = queries.op10_simhash(spark, SF_SMALL).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {k: (prints[k], want[k]) for k in docs}


@pytest.mark.parametrize("group", [3, 8192])
def test_components_by_finer_blocks_and_tile_pairs(spark, group):
    rng = np.random.default_rng(0)
    values = []
    for base in rng.integers(0, 2 ** 63, 4, dtype=np.uint64).tolist():
        for _ in range(30):
            v = base
            for _ in range(rng.integers(0, 5)):
                v ^= 1 << int(rng.integers(0, 64))
            values.append(v)
    prints = dict(enumerate(dict.fromkeys(values)))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(i, signed(v)) for i, v in prints.items()], "id long, fp long")
    got = {r.fp: r.component for r in simhash.components(df, 2, group).collect()}
    want = roots(prints)
    assert got == {signed(v): want[i] for i, v in prints.items()}


def test_forest_connects_exactly_what_links():
    rng = np.random.default_rng(3)
    prints = np.unique(np.concatenate([rng.integers(0, 2 ** 63, 300, dtype=np.uint64),
                                       np.uint64(5) ^ (np.uint64(1) << rng.integers(0, 12, 400).astype(np.uint64))]))
    root = simhash.forest(prints, 2)
    groups, want = defaultdict(set), defaultdict(set)
    for i, r in enumerate(root):
        groups[r].add(i)
    for i, r in roots(dict(enumerate(prints.tolist()))).items():
        want[r].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
