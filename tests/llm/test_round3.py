"""Cross-tokenizer alignment, secret scans and the conversation trie against plain
computations of the same results, on odd input and over several runs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F

from tidemark.llm import alignment, prefix_trie, queries, secret_scan

LONG = "word another " * 60_000
SCHEMA = ("doc_id long, text string, row string, blob string, spans string, n_a string, n_links string, "
          "block string, groups string, n_best string, _ string, tidemark string")


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(1, "Plain words."), (1, "Plain words."), (None, "Plain words."), (3, None), (4, ""), (5, " \n\t "),
             (6, LONG), (7, "x" * 100_000), (8, "émigré 😀 naïve ▁ <0x41> <|endoftext|> <s>"), (9, " two  spaces "),
             (10, "token: abcdefgh PASSWORD='abc12' secret = \"Zq9+/=.\" AKIA" + "Q" * 16 + " " + "0af" * 9),
             (11, "a" * 23 + " " + "a" * 24 + " AKIAshort secret: token: abcdefg K: apikey=abcdef"), (None, None)]
    rows = [(i, t, *(f"{k}{c}" for c in "abcdefghij")) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


# ---- alignment -----------------------------------------------------------------

def plain_alignment(texts):
    """Groups, links and counts of each text by byte ranges alone."""
    import json
    import sentencepiece
    from tokenizers import Tokenizer

    path = queries.BYTE_LEVEL[1]
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    byte_of = {c: b for b, c in alignment.byte_alphabet().items()}
    a_bytes = {i: bytes(byte_of.get(c, 0) for c in e) for e, i in json.load(open(path))["model"]["vocab"].items()}
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES[1])

    def b_bytes(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    out, counts = [], Counter()
    for text in texts:
        text = text or ""
        raw = (" " + text).encode()
        a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        if not text or b"".join(a_bytes[i] for i in a) != raw or b"".join(map(b_bytes, b)) != raw:
            out.append(([], [], [], []))
            continue

        def ranges(ids, of):
            at, got = 0, []
            for i in ids:
                got.append((at, at + len(of(i))))
                at = got[-1][1]
            return got
        ra, rb = ranges(a, a_bytes.__getitem__), ranges(b, b_bytes)
        ends = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, start = [], 0
        for e in ends:
            groups.append(([i for i, r in zip(a, ra) if start < r[1] <= e], [i for i, r in zip(b, rb) if start < r[1] <= e]))
            start = e
        links = [(x, y) for x, r in zip(a, ra) for y, s in zip(b, rb) if r[0] < s[1] and s[0] < r[1]]
        counts.update(links)
        out.append((a, b, groups, links))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    rows = []
    for a, b, groups, links in out:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links),
                     sum(counts[p] for p in links), hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    return rows, counts, most


COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def some_texts(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    short = [r.text for r in rows if r.text and len(r.text) < 900][:60]
    return short + ["", None, " ", "a  b", "ab\ncd\r\n", "émigré 😀 ▁ <0x41> <|endoftext|> </s>", "ａｂｃ ﬁ", "Ω≈ç√ 日本語テキスト",
                    "​zero", "x" * 500, short[0]]


def test_alignment_matches_byte_ranges(spark, monkeypatch):
    texts = some_texts(spark)
    want, counts, most = plain_alignment(texts)
    assert len({w[-1] for w in want}) > 30
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(4)
    got, pairs = alignment.align_corpus(df, queries.BYTE_LEVEL, queries.PIECES)
    rows = {r.k: tuple(r[c] for c in COLS) for r in got.collect()}
    assert rows == dict(enumerate(want))
    assert {(r.a_id, r.b_id): (r["count"], r.best) for r in pairs.collect()} == {
        p: (n, n == most[p[1]]) for p, n in counts.items()}


def test_alignment_query_matches_byte_ranges(spark):
    docs = [r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op11_alignment(spark, SF_SMALL).collect()}
    assert set(got) == {r.doc_id for r in docs}
    # the byte-range links are quadratic: whole-corpus counts are checked through their sums
    texts = [r.text for r in docs if len(r.text or "") < 1200]
    want, _, _ = plain_alignment(texts)
    by_text = {t: w for t, w in zip(texts, want)}
    for r in docs:
        if r.text in by_text:
            g, w = got[r.doc_id], by_text[r.text]
            assert (g.n_a, g.n_b, g.n_groups, g.n_links, g.groups_sha256) == (*w[:4], w[6])
            assert g.n_links == g.n_a + g.n_b - g.n_groups and g.count_sum >= w[5]


@pytest.mark.parametrize("ends_a,ends_b", [([1, 2, 3], [3]), ([3], [1, 2, 3]), ([2, 4, 6], [3, 6]), ([1, 5, 6, 9], [2, 3, 6, 7, 9])])
def test_slices_link_every_overlap(ends_a, ends_b):
    ids_a, ids_b = list(range(len(ends_a))), list(range(len(ends_b)))
    cuts = alignment.common_cuts(ends_a, ends_b)
    _, links = alignment.align(ids_a, ids_b, ends_a, ends_b, *cuts, 0, 0, list("0123"), list("01234"), 100)
    ra, rb = list(zip([0, *ends_a], ends_a)), list(zip([0, *ends_b], ends_b))
    assert sorted(links) == sorted(i * 100 + j for i, r in enumerate(ra) for j, s in enumerate(rb) if r[0] < s[1] and s[0] < r[1])


def test_alignment_blocks_do_not_change_the_result(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(60)
    whole = {tuple(r) for r in alignment.align_corpus(docs, queries.BYTE_LEVEL, queries.PIECES)[0].collect()}
    stage = alignment._stage

    def small(*args):
        run = stage(*args)

        def limited(batches):
            from tidemark.llm import alignment as here
            here.BLOCK_LINKS, here.BLOCK_DOCS = 500, 3
            try:
                yield from run(batches)
            finally:
                here.BLOCK_LINKS, here.BLOCK_DOCS = 2 << 20, 20_000
        return limited
    monkeypatch.setattr(alignment, "_stage", small)
    assert {tuple(r) for r in alignment.align_corpus(docs, queries.BYTE_LEVEL, queries.PIECES)[0].collect()} == whole


def test_alignment_of_odd_rows(spark, odd):
    got, _ = alignment.align_corpus(odd, queries.BYTE_LEVEL, queries.PIECES)
    rows = got.collect()
    assert len(rows) == odd.count() and len(set(got.columns)) == len(got.columns)
    assert {"row", "blob", "block", "_", "spans"} <= set(got.columns)
    assert all(r.row.endswith("a") and r.block.endswith("f") and r["_"].endswith("i") for r in rows)
    for r in rows:
        assert (r.n_a == 0) == (r.groups == "") == (r.groups_sha256 == "")
        assert r.n_links == r.n_a + r.n_b - r.n_groups
    assert {r.doc_id: r.n_a > 0 for r in rows if r.doc_id in (3, 4, 6)} == {3: False, 4: False, 6: True}
    assert alignment.align_corpus(odd.filter("false"), queries.BYTE_LEVEL, queries.PIECES)[0].count() == 0


# ---- secrets -------------------------------------------------------------------

BASE = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
         lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def plain_secrets(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m)]
    return [f"{kind}:{s}:{e}" for s, _, kind, e in sorted(found)]


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_secret_query_matches_plain_search(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op12_secrets(spark, sf).collect()}
    assert set(got) == set(docs)
    for k, text in docs.items():
        want = plain_secrets(text)
        assert got[k].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [got[k].n_assign, got[k].n_access, got[k].n_hex] == [sum(w.startswith(x) for w in want) for x in ("assign", "access", "hex")]
        assert set(want) <= set(got[k].spans.split(","))
    assert len(got) == len(docs)


def test_secrets_of_odd_rows(spark, odd):
    got = secret_scan.scan(odd)
    rows = got.collect()
    assert len(rows) == odd.count() and len(set(got.columns)) == len(got.columns)
    text_of = {r.row: r.text for r in odd.collect()}
    for r in rows:
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.base] == plain_secrets(text_of[r.row])
        assert r.blob == hashlib.sha256((text_of[r.row] or "").encode()).hexdigest()
    assert sum(len(r.spans) for r in rows) >= 6
    assert secret_scan.scan(odd.filter("false")).count() == 0
    maps = odd.select("doc_id", "text", F.create_map("row", "_").alias("m"))
    assert secret_scan.scan(maps).count() == odd.count()


def test_ledger_scans_unseen_pairs_only(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    one = spark.createDataFrame([("a", 1, "token=abcdef1"), ("b", 1, "token=abcdef1"), ("c", 1, "nothing")],
                                "path string, version int, text string")
    two = spark.createDataFrame([("a", 2, "api_key: 123456"), ("d", 1, "token=abcdef1"), ("e", 1, None)],
                                "path string, version int, text string")
    scanned = lambda: sorted((bytes(r.blob).hex()[:6], tuple(sorted(r.rules)))
                             for r in spark.read.schema(secret_scan.LEDGER).parquet(ledger).collect())
    first = {(r.path, r.version): [s.kind for s in r.spans] for r in secret_scan.scan(one, ledger).collect()}
    assert first == {("a", 1): ["assign"], ("b", 1): ["assign"], ("c", 1): []}
    assert len(scanned()) == 2                                   # one copy of each blob
    both = {(r.path, r.version): [s.kind for s in r.spans] for r in secret_scan.scan(one.union(two), ledger).collect()}
    assert both == first | {("a", 2): ["assign"], ("d", 1): ["assign"], ("e", 1): []}
    assert len(scanned()) == 4                                   # two new blobs; the known one on a new path was not read
    assert secret_scan.scan(one.union(two), ledger).count() == 6
    assert len(scanned()) == 4                                   # nothing left to scan
    newer = [secret_scan.Rule("assign", 2, "nothing", base=True), *secret_scan.RULES[1:]]
    again = {(r.path, r.version): [s.kind for s in r.spans] for r in secret_scan.scan(one.union(two), ledger, newer).collect()}
    assert again == {k: ["assign"] if k == ("c", 1) else [] for k in both}
    assert [r for _, r in scanned()].count(("assign@2",)) == 4    # old blobs for the new version alone
    # the old rules still find what they found, without a scan
    assert {(r.path, r.version): [s.kind for s in r.spans] for r in secret_scan.scan(one.union(two), ledger).collect()} == both
    assert len(scanned()) == 8


def test_further_formats(spark):
    text = ("-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1B2" * 9 + " xoxb-1234567890-abc eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh_-1 "
            "postgres://user:pa55@db/x https://example.org/a:b@c")
    got = secret_scan.scan(spark.createDataFrame([(text,)], "text string")).first()
    assert [s.kind for s in got.spans] == ["private_key", "code_host_token", "chat_token", "signed_token", "url_password"]
    assert not any(s.base for s in got.spans)


# ---- conversation trie -----------------------------------------------------------

def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn, role or "", text or ""))
    for c in own:
        own[c].sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()[:16]))
        own[c] = [t[1:] for t in own[c]]
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        head = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])
        out[c] = tuple(head[:h] + own[c][h:])
    return out


def plain_trie(paths):
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = Counter(k[:-1] for k in members if k)
    words = lambda k: len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * words(k)
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in sorted(c for c in m if len(paths[c]) == len(k))).encode()).hexdigest())
                  for k, m in members.items())


def trie_rows(df, **kw):
    own = prefix_trie.paths(df)
    got = prefix_trie.prefix_trie(prefix_trie.share_openings(own), **kw).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got)


def talk(seed, n):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-60, 40 * n), n):
        hot = r.random() < 0.4
        for t in range(r.randint(1, 7)):
            text = "same opening words" if hot and t < 4 else " ".join(r.choice("a b c".split()) for _ in range(r.randint(0, 2)))
            rows.append((c, None if r.random() < 0.02 else t, r.choice(["user", "user", None, ""]), r.choice([text, text, None])))
    return rows


@pytest.mark.parametrize("turns", [1, 7, 60, 200_000])
def test_trie_matches_plain_prefixes(spark, turns):
    rows = talk(turns, 400) + [(None, 1, "user", "lost"), (5, 0, "user", "x"), (5, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    assert trie_rows(df, shard_turns=turns) == plain_trie(rebuilt(rows))


def test_trie_of_a_long_and_of_equal_conversations(spark):
    long = [(0, t, "user", f"turn {t % 3}") for t in range(700)] + [(1, t, "user", f"turn {t % 3}") for t in range(701)]
    same = [(c, t, "user", "hello there") for c in range(100, 1500) for t in range(2)]
    df = spark.createDataFrame(long + same, "conv_id long, turn int, role string, text string")
    for turns in (50, 200_000):
        assert trie_rows(df, shard_turns=turns) == plain_trie(rebuilt(long + same))


def test_trie_query_and_empty_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                  r.n_leaves, r.saved_tokens, r.ends_sha256) for r in queries.op13_prefix_trie(spark, SF_SMALL).collect())
    assert got == plain_trie(rebuilt(rows))
    none = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert trie_rows(none) == []
    assert trie_rows(spark.createDataFrame([(None, 1, "a", "b")], none.schema)) == []
    assert len(trie_rows(spark.createDataFrame([(21, 0, "a", "b")], none.schema))) in (1, 2)


def test_double_array_holds_what_was_packed():
    r = random.Random(3)
    seqs = sorted({tuple(r.randint(1, 60) for _ in range(r.randint(0, 6))) for _ in range(3000)})
    trie = prefix_trie.DoubleArray([list(s) for s in seqs])
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    state = {(): 0}
    for p in sorted(prefixes, key=len)[1:]:
        state[p] = trie.child(state[p[:-1]], p[-1])
        assert state[p] > 0 and trie.check[state[p]] == state[p[:-1]]
    assert len(set(state.values())) == len(prefixes) == len(trie.order)
    assert all(trie.child(state[p], 61) == -1 for p in list(prefixes)[:200])
    assert len(trie.check) < 3 * len(prefixes)


# ---- licence scan: comparison both ways -------------------------------------------

def plain_fits(line, licences):
    """Every template's best stretch by trying all, short lines only."""
    pairs = licences._pairs_of(line)
    out = {}
    for t, (_, own) in enumerate(licences._templates()):
        shared = set(pairs) & set(own)
        if not shared:
            continue
        best = len(shared) / len(set(pairs))
        for i, p in enumerate(pairs):
            if p in own:
                inside = [k for k in range(i, len(pairs)) if k < i + 1.5 * len(own) + 1 and pairs[k] in own]
                both = {pairs[k] for k in inside}
                best = max(best, 2 * len(both) / (len(own) + inside[-1] - i + 1))
        out[t] = best
    return out


def test_licence_stretches_match_a_plain_search(spark):
    from tidemark.llm import licences

    rng = random.Random(5)
    some = [t for ts in licences.TEMPLATES.values() for t in ts]
    lines = some + ["", "no licence here"] + [
        " ".join(rng.sample("the of this work is a town by its river".split(), 6) + w[rng.randrange(3):len(w) - rng.randrange(3)]
                 + ["and", "so", "on"]) for w in (t.split() for t in rng.choices(some, k=40))]
    df = spark.createDataFrame(list(enumerate(lines)), "k int, paragraph string")
    df = df.withColumn("words", licences.words(F.col("paragraph"))).withColumn("pairs", licences.pairs("words"))
    for r in df.select("k", licences.fits("words", "pairs").alias("fits")).collect():
        got = {f.t: f.sim for f in r.fits}
        want = plain_fits(lines[r.k], licences)
        assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in got), lines[r.k]


def test_notices_inside_lines_and_near_relatives(spark):
    from tidemark.llm import licences

    cases = {
        "This article by A and B, first printed in C, is licensed under CC BY 4.0.": "cc_by",
        "The town lies by its river. Licensed under the MIT License.": "mit",
        "This work is licensed under the GNU Affero General Public License, version 3.": "agpl",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "cc_by_nd",
        "Licensed under CC BY-NC-SA 4.0.": "cc_by_nc_sa", "Licensed under CC BY-NC-ND 4.0.": "cc_by_nc_nd",
        "word " * 3000 + "Licensed under the Apache License, Version 2.0. " + "other " * 3000: "apache",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "He licensed the song to a film and the rights of the author were reserved.": "unknown",
        "My driving license was lost in the rain.": "unknown"}
    own = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(cases)], "doc_id long, text string")
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.family for r in licences.scan(base.unionAll(own)).collect() if r.doc_id < 0}
    assert [got[-i - 1] for i in range(len(cases))] == list(cases.values())


# ---- callers' columns under any name ------------------------------------------------

def test_helper_names_never_meet_the_callers(spark, tmp_path):
    import corpus_pipeline
    from tidemark.llm import pii, quality, simhash

    names = ["tidemark_row", "tidemark_fp", "tidemark_score", "tidemark_found", "tidemark_more", "tidemark_spans", "score",
             "q_lines", "q_upper", "q_text", "q_votes", "row", "fp", "id", "spans", "component", "h", "z"]
    prose = "These are plain words of a short text, and they say nothing at all. It ends here with {} words."
    rows = [(i, prose.format("many" * (i % 7 + 1)) + f" Write to a{i}@b.co today.", 0, *(f"{n}{i}" for n in names)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, " + ", ".join(f"{n} string" for n in names))

    def held(out, less=()):
        got = out.collect()
        assert len(got) > 0
        for r in got:
            assert all(r[n] == f"{n}{r.doc_id}" for n in names if n not in less)
        return got

    assert len(held(pii.find(df), ("spans",))) == 20
    assert len(held(pii.find(df, spans_col="found"))) == 20
    hidden = held(pii.redact(df))
    assert all("<EMAIL>" in r.text and r.n_chars == len(r.text) for r in hidden)
    assert pii.redact(df).columns == df.columns == simhash.keep_one(df).columns == quality.keep_good(df).columns
    held(simhash.keep_one(df, size=3, radius=2))
    assert len(held(quality.judge(df))) == 20
    held(quality.keep_good(df))
    labels = spark.createDataFrame([(i, 1, int(i % 2)) for i in range(20)], "doc_id long, quality int, toxic int")
    labels.write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.drop_toxic(spark, df, str(tmp_path))
    assert out.columns == df.columns
    for r in out.collect():
        assert all(r[n] == f"{n}{r.doc_id}" for n in names)


# ---- oracle SQL ------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_query_matches_its_sql(spark, name, sf):
    from oracle_compare import compare, duck

    problems = compare(spark, duck(sf), queries.QUERIES[name], queries.ORACLES[name], sf)
    assert not problems, problems


# ---- toxicity: the learner and its features against plain ones ------------------------------

def test_ftrl_matches_a_plain_one():
    import math

    from tidemark.llm import toxicity as t

    rng = random.Random(11)
    rows = [(sorted(rng.sample(range(64), rng.randint(0, 12))), rng.randint(0, 1)) for _ in range(400)]
    model = t.Ftrl(bits=6, alpha=0.5, beta=1.0, l1=0.7, l2=0.3)
    z, n = dict.fromkeys([*range(64), "bias"], 0.0), dict.fromkeys([*range(64), "bias"], 0.0)

    def weight(c):
        l1, l2 = (0.0, 0.0) if c == "bias" else (0.7, 0.3)
        if abs(z[c]) <= l1:
            return 0.0
        return -(z[c] - math.copysign(l1, z[c])) / ((1.0 + math.sqrt(n[c])) / 0.5 + l2)

    import numpy as np
    for at, label in rows:
        model.learn(np.array(at, np.int32), label)
        active = [*at, "bias"]
        w = {c: weight(c) for c in active}
        g = 1 / (1 + math.exp(-sum(w.values()))) - label
        for c in active:
            sigma = (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) / 0.5
            z[c] += g - sigma * w[c]
            n[c] += g * g
    assert np.allclose(model.z, [z[c] for c in range(64)]) and np.allclose(model.n, [n[c] for c in range(64)])
    assert np.allclose(model.weights(np.arange(64)), [weight(c) for c in range(64)])
    assert abs(model.bias - weight("bias")) < 1e-12
    assert 0 < np.count_nonzero(model.weights(np.arange(64))) < 64           # L1 leaves some at zero


@pytest.mark.parametrize("text", ["", "One", "One two, THREE four-five!", "é “quoted” … ... word word word", "a b c d " * 40])
def test_features_are_words_pairs_skips_and_beginnings(text):
    from xxhash import xxh64_intdigest as h

    from tidemark.llm import toxicity as t

    mask, shift = (1 << 64) - 1, 64 - 16
    words = [w for w in (x.strip(t._TRIM) for x in text.lower().split()) if w]
    code = [h(w.encode()) for w in words]
    pair, skip = int(t._PAIR), int(t._SKIP)
    want = {c >> shift for c in code}
    want |= {((((a * pair) & mask) ^ ((b + pair) & mask)) * pair & mask) >> shift for a, b in zip(code, code[1:])}
    want |= {((((a * skip) & mask) ^ ((b + skip) & mask)) * skip & mask) >> shift for a, b in zip(code, code[2:])}
    want |= {h(b"\0" + w[:k].encode()) >> shift for w in words for k in t.STARTS if k < len(w)}
    assert t.Features(16)(text).tolist() == sorted(want)


# ---- quality rules: the posterior decides -----------------------------------------------------

def test_posterior_and_all_must_pass_differ_as_the_labels_say(spark):
    from tidemark.llm import quality

    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    votes = quality.counts(docs, "text").select("doc_id", F.array(*quality.rules().values()).alias("votes"))
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    rows = (quality.judge(docs, keep_text=False).join(votes, "doc_id").join(labels, "doc_id", "left")
            .filter("not base_failed").select("kept", "votes", "label").collect())
    against = [sum(v < 0 for v in r.votes) for r in rows]
    differ = [r for r, n in zip(rows, against) if r.kept != (n == 0)]
    assert len(differ) > 100 and all(r.kept for r in differ)
    assert sum(r.label == 1 for r in differ) > 50 and not any(r.label == 0 for r in differ)
    slight = [[v for v in r.votes if v < 0] for r in rows]
    assert all(r.kept for r, s in zip(rows, slight) if s == [quality.SLIGHT])
    assert not any(r.kept for r, s in zip(rows, slight) if len(s) > 1 or quality.BAD in s)


def test_estimates_match_plain_expectation_maximisation():
    import math

    from tidemark.llm import quality as q

    rng = random.Random(8)
    texts = []
    for _ in range(600):
        bad = rng.random() < 0.15
        texts.append((rng.choice([q.BAD, q.SLIGHT, 0]) if bad and rng.random() < 0.7 else 0, 0 if rng.random() < 0.9 else q.SLIGHT,
                      q.GOOD if rng.random() < (0.5 if bad else 0.9) else 0))
    patterns = sorted((v, texts.count(v)) for v in set(texts))
    start, table = q.estimate(patterns, rounds=7)
    assert start == math.log(0.9 / 0.1)
    alone = {(j, v): sum(t[j] == v and sum(x < 0 for x in t) == 1 for t in texts) / 600 for j in range(3) for v in (q.BAD, q.SLIGHT)}
    now = [dict(q.PRIOR_VOTE) for _ in range(3)]
    for _ in range(7):
        good = []
        for t in texts:
            odds = 0.9 / 0.1
            for j, v in enumerate(t):
                if v:
                    ratio = now[j][v][0] / now[j][v][1]
                    odds *= max(ratio, 1) if v == q.GOOD else min(ratio, 1)
            good.append(odds / (1 + odds))
        for j in range(3):
            for v in q.PRIOR_VOTE:
                got = []
                for y in (0, 1):
                    share = [g if y == 0 else 1 - g for g in good]
                    n = sum(share)
                    got.append((sum(s for s, t in zip(share, texts) if t[j] == v) + q.PRIOR_WEIGHT * n * q.PRIOR_VOTE[v][y])
                               / (n * (1 + q.PRIOR_WEIGHT)))
                if v == q.BAD:
                    got = [min(got[0], q.MOST_FALSE), max(got[1], q.LEAST_CAUGHT)]
                if v != q.GOOD:
                    got[0] = max(got[0], (alone[j, v] - q.PRIOR_BAD) / (1 - q.PRIOR_BAD))
                now[j][v] = tuple(got)
    for a, b in zip(table, now):
        for v in a:
            assert all(abs(x - y) < 1e-6 for x, y in zip(a[v], b[v]))


def test_alignment_lists_pairs_as_sorting_would():
    from tidemark.llm.alignment import Block
    rng, block = np.random.default_rng(5), Block()
    docs = [rng.integers(0, 1 << 40, n).repeat(rng.integers(1, 4, n)) for n in (40, 0, 7)] + [np.arange(9)[::-1] << 33]
    for links in docs:
        block.add(links.astype("<i8").tobytes())
    steps, times, pairs, totals = block.packed()
    want, often = np.unique(np.concatenate(docs), return_counts=True)
    assert pairs.tolist() == want.tolist() and totals.tolist() == often.tolist()
    for links, s, t in zip(docs, steps, times):
        seen, n = np.unique(links, return_counts=True)
        assert pairs[np.cumsum(np.frombuffer(s, "<i4"))].tolist() == seen.tolist() and np.frombuffer(t, "<i4").tolist() == n.tolist()
    assert [len(x) for x in Block().packed()] == [0, 0, 0, 0]


def test_alignment_knows_white_space_that_no_word_split_covers():
    import re
    from tidemark.llm.alignment import by_single
    odd = re.compile(r"\s\s|^\s|\s\Z|[^\S \n]").search
    signs = ["a", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​"]
    for x in signs:
        for y in signs:
            for text in (x, x + y, "a" + x + y, "a" + x + "b" + y + "c", x + "a" + y):
                assert by_single(text) == (not odd(text)), repr(text)
