"""Quality rules as weak supervision: each rule votes good, bad or abstains; EM weighs the votes.

``signals`` measures a text inside its row, with array functions: no row per word, no shuffle. Documents
with equal votes are alike to the model, so EM runs on the table of vote patterns, one row per pattern that occurs (at most 3 to
the power of the number of rules, whatever the number of documents): the E step gives each pattern its probability of
being good, the M step each rule's hit rates from the pattern counts, on good and on bad documents, which are free between a coin's
and certainty. A rule learns what it is worth from how it agrees with the others, so every fault of a text is looked
at by several rules (menus: symbols, single letters, short words; shouting: marks, capitals; and so on): a bad vote
that stands alone among good ones is mostly outvoted, two that agree mostly aren't, and a rule that misfires on many
clean documents loses its weight. A document is kept when its posterior reaches ``KEEP``.

Defined cases: null text has no words; a null ``doc_id`` is kept as it is; repeated rows each get their row; an
empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACES, documents, let, words

WINDOW = 8
KEEP = 0.5
ROUNDS = 300
# EM begins with each rule right on this share of the good and of the bad documents that it votes on, and believes so with
# the weight of ``SMOOTH`` documents; from there on the rates are free within the limits.
SMOOTH = 10.0
START = (0.98, 0.3)
GOOD_LEAST, GOOD_MOST = 0.5, 0.9999
BAD_LEAST, BAD_MOST = 0.01, 0.999
PRIOR, PRIOR_LEAST, PRIOR_MOST = 0.8, 0.02, 0.98
# The chance of good that EM begins with for patterns without, with one, and with more bad votes.
AT_FIRST = (0.95, 0.5, 0.05)

MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_distinct bigint, n_marks bigint, n_lines bigint, n_capitals bigint, n_digits bigint, n_short bigint, n_single bigint"


def repeat_words(ones: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words found twice or more, from the words' hashes.

    Hashes of 2, 4 and 8 words come from each other by pairing neighbours. Only where some window hash repeats,
    windows are sorted by (hash, place); equal neighbours are the repeated ones, and the words they
    cover are counted by the distances between their places.
    """

    def pair(a: Column, step: int) -> Column:
        m = F.size(a) - step
        return F.zip_with(F.slice(a, 1, m), F.slice(a, step + 1, m), lambda x, y: F.xxhash64(x, y))

    def covered(s: Column) -> Column:
        m = F.size(s) - 1
        later = F.zip_with(F.slice(s, 1, m), F.slice(s, 2, m), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return let(F.array_sort(F.array_distinct(F.flatten(F.filter(later, lambda x: x.isNotNull())))), union)

    def union(places: Column) -> Column:
        k = F.size(places) - 1
        gaps = F.zip_with(F.slice(places, 1, k), F.slice(places, 2, k), lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(WINDOW), lambda a, x: a + x)

    def of_windows(windows: Column) -> Column:
        repeated = F.size(windows) > F.size(F.array_distinct(windows))
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(repeated, let(ordered, covered)).otherwise(0)

    windows = let(pair(ones, 1), lambda two: let(pair(two, 2), lambda four: let(pair(four, 4), of_windows)))
    return F.when(F.size(ones) > WINDOW, windows).otherwise(0).cast("long")


def signals(text: Column) -> Column:
    """The measures of a text, a struct."""

    def without(c: Column, pattern: str) -> Column:
        return F.length(F.regexp_replace(c, pattern, ""))

    def no_longer(items: Column, n: int) -> Column:
        return F.size(F.filter(items, lambda w: F.length(w) <= n)).cast("long")

    def of_letters(letters: Column, ones: Column, items: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
        n = F.length(letters)
        return let(lines, lambda kept: F.struct(
            F.size(ones).cast("long").alias("n_words"),
            n.cast("long").alias("word_chars"),
            (n - without(letters, "[#*$%&|<>]++")).cast("long").alias("n_symbols"),
            (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
            repeat_words(ones).alias("n_repeat_words"),
            F.size(F.array_distinct(ones)).cast("long").alias("n_distinct"),
            (n - without(letters, "[!?]{2,}+")).cast("long").alias("n_marks"),
            F.size(kept).cast("long").alias("n_lines"),
            (n - without(letters, r"\p{Lu}++")).cast("long").alias("n_capitals"),
            (n - without(letters, "[0-9]++")).cast("long").alias("n_digits"),
            no_longer(items, 3).alias("n_short"),
            no_longer(items, 1).alias("n_single"),
        ))

    return let(words(text), lambda items: let(F.transform(items, lambda w: F.xxhash64(w)), lambda ones: let(F.array_join(items, ""), lambda letters: of_letters(letters, ones, items))))


def votes() -> dict[str, Column]:
    """1 good, -1 bad, 0 abstains; each rule is silent where it has no opinion."""
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    mean = chars / F.greatest(n, F.lit(1))
    symbols = F.col("n_symbols") / F.greatest(chars, F.lit(1))
    marks = F.col("n_marks") / F.greatest(chars, F.lit(1))
    repeats = F.col("n_repeat_words") / F.greatest(n, F.lit(1))
    twice = F.col("n_dup_lines") / F.greatest(lines, F.lit(1))
    variety = F.col("n_distinct") / F.greatest(n, F.lit(1))

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    def share(name: str, of: Column) -> Column:
        return F.col(name) / F.greatest(of, F.lit(1))

    def from_words(least: int, of: Column) -> Column:
        return F.when(n < least, 0).otherwise(of)

    capitals, digits = share("n_capitals", chars), share("n_digits", chars)
    short, single = share("n_short", n), share("n_single", n)
    rich = variety * F.sqrt(n / 50.0)
    return {
        "length": vote(n >= 40, n < 20),
        "word_length": from_words(20, vote(mean.between(4.2, 5.9), (mean < 3.9) | (mean > 6.4))),
        "symbols": vote(symbols < 0.02, symbols > 0.05),
        "marks": vote(marks < 0.02, marks > 0.05),
        "capitals": from_words(20, vote(capitals < 0.08, capitals > 0.2)),
        "digits": vote(digits < 0.03, digits > 0.1),
        "short_words": from_words(20, vote(short.between(0.2, 0.42), (short < 0.12) | (short > 0.46))),
        "single_letters": from_words(20, vote(single < 0.06, single > 0.15)),
        "repeats": vote(repeats < 0.1, repeats > 0.3),
        "lines": F.when(lines < 3, 0).otherwise(vote(twice < 0.1, twice > 0.4)),
        "variety": from_words(30, vote(rich > 0.6, rich < 0.35)),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[tuple[float, float]]]:
    """Prior of good, and per rule the chances of a right vote on good and on bad documents, given that it votes."""
    n_rules = len(patterns[0][0]) if patterns else 0
    total = sum(n for _, n in patterns)
    good = [AT_FIRST[min(2, sum(v < 0 for v in p))] for p, _ in patterns]
    prior, rates = PRIOR, [START] * n_rules
    for _ in range(ROUNDS):
        weight = [(p, g * n, (1 - g) * n) for g, (p, n) in zip(good, patterns, strict=True)]
        prior = (sum(w for _, w, _ in weight) + SMOOTH * PRIOR) / (total + SMOOTH)
        prior = min(PRIOR_MOST, max(PRIOR_LEAST, prior))
        rates = []
        for j in range(n_rules):
            said, up = (sum(w for p, w, _ in weight if p[j] in votes) for votes in ((1, -1), (1,)))
            said_bad, down = (sum(w for p, _, w in weight if p[j] in votes) for votes in ((1, -1), (-1,)))
            hit = (up + START[0] * SMOOTH) / (said + SMOOTH), (down + START[1] * SMOOTH) / (said_bad + SMOOTH)
            rates.append((min(GOOD_MOST, max(GOOD_LEAST, hit[0])), min(BAD_MOST, max(BAD_LEAST, hit[1]))))
        new = [posterior(p, prior, rates) for p, _ in patterns]
        moved = max((abs(a - b) for a, b in zip(new, good, strict=True)), default=0.0)
        good = new
        if moved < 1e-9:
            break
    return prior, rates


def _weights(prior: float, rates: list[tuple[float, float]]) -> tuple[float, list[tuple[float, float]]]:
    """Log odds of good: the prior's, and per rule those of a good and of a bad vote."""
    return math.log(prior / (1 - prior)), [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in rates]


def posterior(pattern: tuple[int, ...], prior: float, rates: list[tuple[float, float]]) -> float:
    start, weights = _weights(prior, rates)
    odds = start + sum(w[0] if v > 0 else w[1] for v, w in zip(pattern, weights, strict=True) if v)
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))


def judge(docs: DataFrame) -> DataFrame:
    """A row per document: ``doc_id``, the measures, and ``quality``, its posterior probability of being good."""
    rules = votes()
    measured = documents(docs).select("doc_id", signals(F.col("text")).alias("_m")).select("doc_id", "_m.*")
    measured = materialize(measured.withColumns({f"_vote_{r}": v for r, v in rules.items()}), "rule-votes")
    names = [f"_vote_{r}" for r in rules]
    table = sorted((tuple(r[n] for n in names), r["count"]) for r in measured.groupBy(*names).count().collect())
    start, weights = _weights(*fit(table)) if table else (0.0, [(0.0, 0.0)] * len(names))
    odds = reduce(Column.__add__, [F.when(F.col(n) > 0, F.lit(w[0])).when(F.col(n) < 0, F.lit(w[1])).otherwise(0.0) for n, w in zip(names, weights, strict=True)], F.lit(start))
    return measured.withColumn("quality", 1 / (1 + F.exp(-odds))).drop(*names)


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns: base measures, ``base_failed``, and ``kept`` by the posterior."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("quality") >= KEEP)).alias("kept"), F.col("quality").alias("good_probability"),
    )
