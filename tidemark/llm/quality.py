"""Quality by weak supervision, in DataFrame functions only.

Each rule looks at a few counts of a text and votes good, bad, slightly bad or
abstains.  No rule decides alone: expectation-maximisation over the votes of the corpus
estimates how often each rule votes so on good and on bad texts, and a text's posterior
probability of being good follows from its votes.  A rule for a defect has two
thresholds: beyond the second its vote is a strong one, between them a slight one.  One
slight vote is weak evidence, which a text's merits outweigh; two of them, or a strong
one, are not outweighed.

The counts are written once.  Expectation-maximisation sees only how often each
combination of votes occurs among the texts that pass the base rules (at most
``3 ** defects * 2 ** merits`` rows, whatever the corpus).  The share of bad texts is a
stated assumption and is not estimated: an abstention says nothing, so most texts say
nothing about it, and it would drift.  Each estimate is held by prior counts, a fixed
share of its class.  A vote for a defect never speaks for a text, nor one for a merit
against it.  Strong votes also stay within stated bounds (rare on good texts, common on
bad ones): votes alone do not tell a rare defect from a rare whim of a rule, and
without the bounds the commonest defect of a corpus becomes its norm.  A rule that is
the only one against more texts than ``PRIOR_BAD`` of the corpus is wrong about the rest
of them: that share is the least rate of its votes on good texts, so from about 15 % on
even its strong votes are outvoted.

Words are ``[^\\x20\\x09-\\x0D]+``.  Repeated five-word windows are found by 64-bit
hashes of the words, per text, without a shuffle.

Rows: a null or empty text has no words, fails the base rules and is not kept;
repeated rows are judged alike; an empty table gives no rows; added columns
replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import Renamed, text_of, written

WINDOW = 5
GOOD, BAD, SLIGHT = 1, -1, -2
ROUNDS = 50
KEEP = 0.5           # least posterior probability of a kept text

# What is assumed of any rule before a text is seen: the share of (good, bad) texts
# on which it votes so, the share of bad texts, and the weight of this as a share of a class.
PRIOR_VOTE = {BAD: (0.001, 0.30), SLIGHT: (0.03, 0.12), GOOD: (0.80, 0.55)}
PRIOR_BAD = 0.10
PRIOR_WEIGHT = 0.05
# What makes a vote a strong one: it falls on few good texts (unless the rule is often alone
# in it, see ``lone_excess``) and on many bad ones.
MOST_FALSE, LEAST_CAUGHT = 0.002, 0.25

_GAP = r"[\x20\x09-\x0D]+"


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts (prefixed ``q_``) that the rules look at."""
    text = text_of(text_col)
    rows = docs.withColumn("q_text", text)
    rows = rows.withColumn("q_words", F.array_remove(F.split("q_text", _GAP), ""))
    rows = rows.withColumn("q_hash", F.transform("q_words", lambda w: F.xxhash64(w)))
    last = F.size("q_words") - WINDOW
    rows = rows.withColumn("q_windows", F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                    lambda i: F.xxhash64(*[F.get("q_hash", i + k) for k in range(WINDOW)]))))
    lines = F.filter(F.split("q_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("q_lines", lines)

    def number(c: Column) -> Column:
        return c.cast("long")

    def without(pattern: str) -> Column:
        return number(F.length(F.regexp_replace("q_text", pattern, "")))

    rows = rows.select(
        "*",
        number(F.size("q_words")).alias("n_words"),
        number(F.length(F.array_join("q_words", ""))).alias("word_chars"),
        without(r"[^#*$%&|<>]+").alias("n_symbols"),
        number(F.size("q_lines") - F.size(F.array_distinct("q_lines"))).alias("n_dup_lines"),
        F.when(F.size("q_windows") == F.size(F.array_distinct("q_windows")), F.lit(0).cast("long"))
        .otherwise(_covered("q_windows")).alias("n_repeat_words"),
        number(F.size("q_lines")).alias("q_n_lines"),
        without(r"\P{Lu}+").alias("q_upper"),
        without(r"\P{L}+").alias("q_letters"),
        without(r"[^!]+").alias("q_shouts"),
        number(F.regexp_count("q_text", F.lit(r"[\p{L}\p{N}][.!?](?=\s|$)"))).alias("q_ends"),
        number(F.size(F.filter("q_hash", lambda h, i: h == F.get("q_hash", i - 1)))).alias("q_stutter"),
        number(F.size(F.array_distinct("q_hash"))).alias("q_distinct"))
    return rows.drop("q_text", "q_words", "q_hash", "q_windows", "q_lines")


def _covered(windows: str) -> Column:
    """Words in windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    # array(x) with transform names x once; a lambda would work it out again for each element
    twice = F.flatten(F.transform(F.array(pairs), lambda s: F.filter(
        F.transform(s, lambda x, i: F.when(
            F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)), x["p"])),
        lambda p: p.isNotNull())))
    steps = F.flatten(F.transform(F.array(F.sort_array(twice)), lambda q: F.transform(
        q, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(q, i + 1) - p, F.lit(WINDOW))))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def rules() -> dict[str, Column]:
    """Votes: 1 good, -1 bad, -2 slightly bad, 0 abstain.  A rule for a defect votes
    bad, slightly bad or abstains, a rule for a merit votes good or abstains."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda c, of=words: F.col(c) / of
    letters = F.greatest(F.col("q_letters"), F.lit(1))
    lines = F.greatest(F.col("q_n_lines"), F.lit(1))
    long_enough = F.col("n_words") >= 20
    lettered = F.col("q_letters") >= 40
    mean = F.col("word_chars") / words

    def over(c: Column, slight: float, strong: float, where: Column | None = None) -> Column:
        vote = F.when(c > strong, BAD).when(c > slight, SLIGHT).otherwise(0)
        return vote if where is None else F.when(where, vote).otherwise(0)

    defects = {
        "short": F.when(F.col("n_words") < 10, BAD).when(F.col("n_words") < 20, SLIGHT).otherwise(0),
        "symbols": over(share("n_symbols"), 0.05, 0.2),
        "repeats": over(share("n_repeat_words"), 0.1, 0.25),
        "stutter": over(share("q_stutter"), 0.05, 0.2),
        "lines": over(share("n_dup_lines", lines), 0.15, 0.3, F.col("n_dup_lines") >= 2),
        "word_length": F.when((mean < 2) | (mean > 16), BAD).when((mean < 3) | (mean > 10), SLIGHT).otherwise(0),
        "capitals": over(share("q_upper", letters), 0.15, 0.4, lettered),
        "shouts": over(share("q_shouts"), 0.05, 0.2, long_enough),
        "sameness": over(-share("q_distinct"), -0.3, -0.1, long_enough & (F.col("n_words") < 2000)),
    }
    merits = {
        "sentences": long_enough & share("q_ends").between(0.01, 0.3),
        "casing": lettered & share("q_upper", letters).between(0.003, 0.15),
        "variety": long_enough & ((share("q_distinct") > 0.3) | (F.col("n_words") >= 2000)),
    }
    return (defects
            | {k: F.when(c, GOOD).otherwise(0) for k, c in merits.items()})


def lone_excess(patterns: list[tuple[tuple[int, ...], int]], total: float) -> list[dict[int, float]]:
    """For each rule and kind of vote against a text, the least share of good texts that
    get it: at most ``PRIOR_BAD`` of the corpus are taken for bad texts that no other
    rule objects to."""
    k = len(patterns[0][0]) if patterns else 0
    alone = [{BAD: 0.0, SLIGHT: 0.0} for _ in range(k)]
    for votes, n in patterns:
        against = [j for j, v in enumerate(votes) if v in (BAD, SLIGHT)]
        if len(against) == 1:
            alone[against[0]][votes[against[0]]] += n
    return [{v: max(0.0, a / total - PRIOR_BAD) / (1 - PRIOR_BAD) for v, a in x.items()} for x in alone]


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[dict]]:
    """Log-odds (good to bad) before any vote, and for each rule and vote the share
    of (good, bad) texts with that vote, by expectation-maximisation.  An abstention
    says nothing: a text has one defect as a rule, so that the other rules see none is no
    sign in its favour."""
    total = float(sum(n for _, n in patterns)) or 1.0
    k = len(patterns[0][0]) if patterns else 0
    least = lone_excess(patterns, total)
    start = math.log((1 - PRIOR_BAD) / PRIOR_BAD)
    table = [dict(PRIOR_VOTE) for _ in range(k)]
    for _ in range(rounds):
        mass = [{v: [0.0, 0.0] for v in PRIOR_VOTE} for _ in range(k)]
        weight = [1e-9, 1e-9]
        for votes, n in patterns:
            odds = start + sum(gain(table[j], v) for j, v in enumerate(votes))
            good = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            for y, share in ((0, n * good), (1, n * (1 - good))):
                weight[y] += share
                for j, v in enumerate(votes):
                    if v:
                        mass[j][v][y] += share
        table = []
        for m, low in zip(mass, least):
            share = {v: [(m[v][y] + PRIOR_WEIGHT * weight[y] * PRIOR_VOTE[v][y]) / (weight[y] * (1 + PRIOR_WEIGHT))
                         for y in (0, 1)] for v in m}
            share[BAD] = [min(share[BAD][0], MOST_FALSE), max(share[BAD][1], LEAST_CAUGHT)]
            for v, least_good in low.items():
                share[v][0] = max(share[v][0], least_good)
            table.append({v: tuple(s) for v, s in share.items()})
    return start, table


def gain(shares: dict, vote: int) -> float:
    """What a vote adds to the log-odds of good."""
    if not vote:
        return 0.0
    said = math.log(shares[vote][0] / shares[vote][1])
    return max(said, 0.0) if vote == GOOD else min(said, 0.0)


def judge(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, quality`` (posterior probability of good) and ``kept``.  Other columns
    of any name stay; only those names are replaced."""
    own = Renamed(docs)
    return own.back(_judge(own.frame, own.of(text_col), keep_text), _MADE, () if keep_text else (text_col,))


_MADE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality", "kept")


def _judge(docs: DataFrame, text_col: str, keep_text: bool) -> DataFrame:
    named = rules()
    names = [c for c in docs.columns if keep_text or c != text_col]
    rows = counts(docs, text_col).select(
        *[F.col(f"`{c}`") for c in names], *_MADE[:5], F.array(*named.values()).alias("q_votes"))
    rows = written(rows, "quality")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    patterns = [(tuple(r.q_votes), r.n) for r in      # a bounded number of combinations
                rows.filter(~failed).groupBy("q_votes").agg(F.count(F.lit(1)).alias("n")).orderBy("q_votes").collect()]
    start, table = estimate(patterns)
    odds = F.lit(start)
    for j, shares in enumerate(table):
        v = F.col("q_votes")[j]
        odds = odds + F.when(v == BAD, gain(shares, BAD)).when(v == SLIGHT, gain(shares, SLIGHT)) \
            .when(v == GOOD, gain(shares, GOOD)).otherwise(0.0)
    rows = rows.withColumn("base_failed", failed).withColumn("quality", 1 / (1 + F.exp(-odds)))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP)).drop("q_votes")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    own = Renamed(docs)
    return own.back(_judge(own.frame, own.of(text_col), True).filter("kept"))
