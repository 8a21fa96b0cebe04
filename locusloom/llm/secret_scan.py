"""Secret scan: a trigram inverted index answers a Boolean query per rule, candidates are verified by its regex.

From each rule's regex follows what every match must contain: clauses (all must hold), each a choice of
literals, each literal the set of its trigrams. ``trigram_index`` has the postings of just these trigrams;
intersecting them per text gives the rules that can match at all. Only those are tried on a text. A rule
without a mandatory trigram (long runs of hex digits) scans every text.

Defined cases: null text is an empty text without spans; a null ``doc_id`` is kept as it is; repeated rows
each get their row; an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
Spans of different kinds may overlap; of one kind they don't. A base match whose value is too short is dropped, but
its text is used up; what begins inside such text is a kind of its own, ``INSIDE``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import documents, let, matches, spans_text

# An alternative set larger than this is not expanded into literals.
MAX_LITERALS = 32
# Letters from common to rare: picks the trigram of a literal that fewest texts should hold.
COMMON_LETTERS = "etaoinshrdlcumwfgypbvkjxqz"

Clause = list[frozenset[str]]


@dataclass(frozen=True)
class Rule:
    """With ``head``, matches are those of ``whole``; ones with less than ``least`` code points behind their head are dropped."""

    name: str
    pattern: str
    head: str = ""
    whole: str = ""
    least: int = 0


KEY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
# Fixed by the result's contract. Lower bounds on lengths stand in the patterns where a run that is too short has
# no longer match inside it, since runs are maximal. A short value may hold a keyword, so it is dropped after matching.
BASE_RULES = (
    Rule("assign", KEY + "[A-Za-z0-9+/_.=-]{12,}", KEY, KEY + "[A-Za-z0-9+/_.=-]++", 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{30,}"),
    Rule("slack", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES
INSIDE = "assign_inside"


def trigrams(literal: str) -> frozenset[str]:
    return frozenset(literal[i : i + 3] for i in range(len(literal) - 2))


def _literals(op: str, value) -> set[str] | None:
    """All strings that a parsed piece of a regex can match, lower-cased, if they are few."""
    if op == "LITERAL":
        return {chr(value).lower()}
    if op == "IN":
        parts = [_literals(str(o), v) for o, v in value]
        return set().union(*parts) if None not in parts and len(parts) <= MAX_LITERALS else None
    if op == "BRANCH":
        parts = [_sequence(p) for p in value[1]]
        return set().union(*parts) if None not in parts else None
    if op == "SUBPATTERN":
        return _sequence(value[-1])
    if op == "MAX_REPEAT" and value[1] == 1:
        inner = _sequence(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _sequence(parsed) -> set[str] | None:
    out = {""}
    for op, value in parsed:
        part = _literals(str(op), value)
        if part is None or len(out) * len(part) > MAX_LITERALS:
            return None
        out = {a + b for a, b in product(out, part)}
    return out


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that hold for every text with a match; a clause holds if one of its trigram sets is there."""
    clauses, run = [], {""}
    for op, value in [*re._parser.parse(pattern), ("END", None)]:
        part = _literals(str(op), value)
        if part is not None and len(run) * len(part) <= MAX_LITERALS:
            run = {a + b for a, b in product(run, part)}
            continue
        if min(map(len, run)) >= 3:
            clauses.append(sorted({trigrams(s) for s in run}, key=sorted))
        run = part if part is not None and len(part) <= MAX_LITERALS else {""}
    return clauses


def _rarest(options: frozenset[str]) -> str:
    rank = {c: i for i, c in enumerate(COMMON_LETTERS)}
    return max(sorted(options), key=lambda t: sum(rank.get(c, len(rank)) for c in t))


def _keyed(docs: DataFrame) -> DataFrame:
    return documents(docs).withColumn("_hash", F.xxhash64("text"))


def trigram_index(docs: DataFrame, asked: list[str]) -> DataFrame:
    """Postings (trigram, doc_id, _hash) of the asked trigrams, whatever their case."""
    low = F.lower("text")
    there = F.concat(*[F.when(F.contains(low, F.lit(t)), F.array(F.lit(t))).otherwise(F.array().cast("array<string>")) for t in asked])
    return _keyed(docs).select("doc_id", "_hash", F.explode(there).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[Clause]]) -> DataFrame:
    """Texts (doc_id, _hash) with ``rules``: those whose clauses the intersected postings satisfy."""
    have = F.col("_have")

    def holds(clause: Clause) -> Column:
        return reduce(Column.__or__, [F.size(F.array_intersect(have, F.array(*map(F.lit, sorted(s))))) == len(s) for s in clause])

    rules = [F.when(reduce(Column.__and__, map(holds, q)), F.lit(n)) for n, q in queries.items()]
    return (
        index.groupBy("doc_id", "_hash")
        .agg(F.collect_set("trigram").alias("_have"))
        .select("doc_id", "_hash", F.array_compact(F.array(*rules)).alias("rules"))
        .where(F.size("rules") > 0)
    )


def _spans(rules: list[Rule], order: dict[str, int], only: Column | None = None) -> Column:
    def placed(found: Column, kind: int) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))

    def of(rule: Rule) -> Column:
        guard = None if only is None else F.array_contains(only, rule.name)
        if not rule.head:
            return placed(matches(F.col("text"), rule.pattern, guard), order[rule.name])

        def long(m: Column) -> Column:
            return F.length(m["value"]) - F.length(F.regexp_extract(m["value"], "^" + rule.head, 0)) >= rule.least

        def split(every: Column) -> Column:
            return let(F.filter(every, long), lambda kept: F.concat(placed(kept, order[rule.name]), inside(every, kept)))

        def inside(every: Column, kept: Column) -> Column:
            others = F.filter(matches(F.col("text"), rule.pattern), lambda m: ~F.exists(kept, lambda k: k["start"] == m["start"]))
            return F.when(F.size(every) > F.size(kept), placed(others, len(order))).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))

        return let(matches(F.col("text"), rule.whole, guard), split)

    return F.concat(*map(of, rules))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row per document: ``doc_id`` and ``found``, its sorted array of (start, kind: place in ``rules``, behind them ``INSIDE``, end)."""
    order = {r.name: i for i, r in enumerate(rules)}
    queries = {r.name: q for r in rules if (q := trigram_query(r.pattern))}
    indexed = [r for r in rules if r.name in queries]
    unindexed = [r for r in rules if r.name not in queries]
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    keyed = _keyed(docs)
    everywhere = keyed.select("doc_id", "_hash", (_spans(unindexed, order) if unindexed else none).alias("_all"))
    if not indexed:
        return everywhere.select("doc_id", F.array_sort("_all").alias("found"))

    asked = sorted({t for q in queries.values() for clause in q for s in clause for t in s})
    able = candidates(materialize(trigram_index(docs, asked), "trigrams"), queries)
    # Texts without the rarest trigram of any choice of a first clause can't be candidates: they stay where they are.
    first = sorted({_rarest(s) for q in queries.values() for s in q[0]})
    likely = keyed.where(reduce(Column.__or__, [F.contains(F.lower("text"), F.lit(t)) for t in first]))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_hash"] == b["_hash"])
    verified = (
        likely.join(able, same(likely, able))
        .select(likely["doc_id"], likely["_hash"], "text", "rules")
        .select("doc_id", "_hash", _spans(indexed, order, F.col("rules")).alias("_some"))
        .where(F.size("_some") > 0)
        .dropDuplicates(["doc_id", "_hash"])
    )
    return everywhere.join(verified, same(everywhere, verified), "left").select(
        everywhere["doc_id"], F.array_sort(F.concat("_all", F.coalesce("_some", none))).alias("found")
    )


def report(docs: DataFrame) -> DataFrame:
    """The digest of ``scan``: counts of the base kinds, a hash of their spans, all spans as text."""
    n_base = len(BASE_RULES)
    base = F.filter("found", lambda s: s["kind"] < n_base)
    names = [*(r.name for r in RULES), INSIDE]

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{names[kind]}")

    counts = map(count, range(n_base))
    return scan(docs).select("doc_id", *counts, F.sha2(spans_text(base, names), 256).alias("base_sha256"), spans_text(F.col("found"), names).alias("spans"))
