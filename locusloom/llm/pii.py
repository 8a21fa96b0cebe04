"""Personal data: generators propose overlapping spans, boosted trees score them, calibrated thresholds select.

Generators favour recall; most of what they propose beyond the strict kinds (email, ip, card, phone) is
not personal. A candidate is described by a few small whole numbers about its format and its surroundings.
Candidates with equal features fall into one cell, so all that the corpus has to say about them is a small
table of counts per cell; the trees are fitted to that table on the driver. Its size is bounded by the
features' levels, whatever the number of documents. The fitted trees are plain ``CASE`` expressions again.

There are no labelled spans, so the label is distant: a candidate counts as personal if a strict rule proves it, or if a
word shortly before names it (``EVIDENT``: a phone number after "call", a person's number after "ssn"; an address spelled
with a bracketed "at" names itself). These are always kept. The naming words are no features, so trees must
tell the others by their format and the rest of their surroundings: where candidates of such a look are mostly named, those
without a name go too, and where they mostly aren't (part numbers, say), they stay. Cells are counted in two folds of
documents; one fits the trees, the other sets each generator's threshold, the lowest score from which on at least
``TRUST`` of its candidates are named, among ``SUPPORT`` at least; without so many there is none, and only named ones
go. Candidates inside a strict match are part of it and not looked at.

Defined cases: null text is an empty text without spans; a null ``doc_id`` is kept as it is; repeated rows each get
their row; an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored by
``find``, and kept by ``redact``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import documents, matches, spans_text

# Strict kinds, fixed by the result's contract; possessive quantifiers match the same runs without backtracking.
# After the end of a match (\G) an address may begin inside a run of its characters.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators of more candidates; what they add is a kind of its own in the result.
LOOSE = {
    "mail_words": r"[A-Za-z0-9._%+-]{2,64}\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]{2,64}(?:\x20?(?:[(\[](?:dot|DOT)[)\]]|\.)\x20?[A-Za-z0-9-]{2,32}){1,4}",
    "local_phone": r"\(?[0-9]{3}[)\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "number": r"[0-9](?:[\x20.-]?[0-9]){7,}+",
    "person_id": r"(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])",
}
# Candidates of these kinds are personal where the text shortly before them, in lower case, matches: the distant labels.
EVIDENT = {
    "mail_words": "",
    "local_phone": r"phone|\b(?:tel|call|cell|fax)\b|mobil|whatsapp",
    "number": r"\biban\b|\baccount\b|\bcard\b",
    "person_id": r"\bssn\b|social security|passport",
}
KINDS = [*STRICT, *LOOSE]
NEAR = 24  # code points before a candidate that count as its surroundings

# Features: name, number of levels. Levels are 0 .. n - 1.
LEVELS = {"kind": len(KINDS), "digits": 8, "signs": 4, "luhn": 2, "plus": 2, "word": 5, "before": 3, "after": 3}
ROUNDS, RATE = 25, 0.4
# Share of named candidates from a threshold on, and how many candidates must speak for one.
TRUST, SUPPORT = 0.6, 20

CANDIDATE = "start:int,kind:int,end:int,strict:boolean,evident:boolean," + ",".join(f"{n}:int" for n in LEVELS if n != "kind")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of digits, every second from the right doubled (less 9 above 9), divisible by 10."""

    def worth(d: Column, i: Column) -> Column:
        n = d.cast("int")
        twice = 2 * n
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(n)

    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), worth)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        part = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(part, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return n.between(12, 19) & _luhn(_digits(value))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(kind == "email")


def _level(c: Column, *bounds: int) -> Column:
    """The number of bounds that ``c`` reaches."""
    return reduce(Column.__add__, [(c >= b).cast("int") for b in bounds])


def _candidate(text: Column, kind: str, m: Column) -> Column:
    value, start, end = m["value"], m["start"], m["end"]
    digits = _digits(value)
    n = F.length(digits)
    near = F.lower(F.substring(text, F.greatest(start - NEAR + 1, F.lit(1)), F.least(start, F.lit(NEAR))))
    # What leads to the candidate, naming words left out.
    word = (
        F.when(near.rlike(r"(?:\b(?:part|lot|order|item|model|serial|invoice|ref|no|nr|id|version|isbn)\b[.#:\x20]*)$"), 3)
        .when(near.rlike(r"\b(?:is|at|on|to|my|me|or|under)[\x20:]*$"), 1)
        .when(near.rlike(r"[:=#][\x20]*$"), 2)
        .when(near.rlike(r"[a-z][\x20]*$"), 4)
        .otherwise(0)
    )

    def edge(c: Column) -> Column:
        return F.when(c.rlike("[A-Za-z0-9]"), 2).when(c.rlike(r"[.,:=_/-]"), 1).otherwise(0)

    return F.struct(
        start.alias("start"),
        F.lit(KINDS.index(kind)).alias("kind"),
        end.alias("end"),
        _valid(kind, value).alias("strict"),
        (near.rlike(EVIDENT[kind]) if kind in EVIDENT else F.lit(False)).alias("evident"),
        _level(n, 1, 4, 8, 9, 12, 16, 20).alias("digits"),
        _level(F.length(value) - n, 1, 3, 6).alias("signs"),
        (F.when(n.between(12, 19), _luhn(digits)).otherwise(False)).cast("int").alias("luhn"),
        value.startswith("+").cast("int").alias("plus"),
        word.alias("word"),
        edge(F.when(start > 0, F.substring(text, start, F.lit(1))).otherwise(F.lit(" "))).alias("before"),
        edge(F.substring(text, end + 1, F.lit(1))).alias("after"),
    )


def candidates(text: Column) -> Column:
    """All proposed spans of a text with their features, an array sorted by start and kind."""
    has_number = text.rlike("[0-9]")
    guards = {"email": F.contains(text, F.lit("@")), "ip": has_number, "card": has_number, "phone": F.contains(text, F.lit("+")), "mail_words": text.rlike(r"(?i)[(\[]at[)\]]")}
    # Shorter chains than 12 digits can't be cards and hold no longer ones.
    sought = {**STRICT, **LOOSE, "card": r"[0-9](?:[\x20-]?[0-9]){11,}+"}

    def of(kind: str) -> Column:
        return F.transform(matches(text, sought[kind], guards.get(kind, has_number)), lambda m: _candidate(text, kind, m))

    return F.array_sort(F.concat(*map(of, KINDS)))


# ---------------------------------------------------------------- boosting on the table of cells


def cells(found: DataFrame) -> list[dict]:
    """Counts of candidates and of proved or named ones per feature cell and fold; bounded by the levels, not by the data."""
    labelled = F.transform(_apart("found"), lambda c: F.struct(c.alias("c"), (c["strict"] | c["evident"]).alias("y")))
    rows = found.select((F.pmod(F.xxhash64("doc_id"), F.lit(2))).cast("int").alias("fold"), F.explode(labelled).alias("x"))
    names = [F.col(f"x.c.{n}").alias(n) for n in LEVELS]
    return [r.asDict() for r in rows.select("fold", *names, F.col("x.y").cast("int").alias("y")).groupBy("fold", *LEVELS).agg(F.count("*").alias("n"), F.sum("y").alias("y")).collect()]


def _apart(found: Column | str) -> Column:
    """Candidates without those of the loose kinds that lie inside a strict match."""
    found = F.col(found) if isinstance(found, str) else found
    strict = F.filter(found, lambda s: s["strict"])
    return F.filter(found, lambda c: (c["kind"] < len(STRICT)) | ~F.exists(strict, lambda s: (s["start"] <= c["start"]) & (s["end"] >= c["end"])))


def _leaf(rows: list[tuple]) -> tuple[float, float, float]:
    """Newton step, its gain, and the weight of rows (features, n, gradient, curvature)."""
    g, h = sum(r[2] for r in rows), sum(r[3] for r in rows)
    return g / (h + 1.0), g * g / (h + 1.0), h


def _split(rows: list[tuple]):
    """Best (gain, feature, level set as a threshold on the level; kinds by equality)."""
    best = (0.0, None, None)
    whole = _leaf(rows)[1]
    for name, n_levels in LEVELS.items():
        for v in range(n_levels):
            left = [r for r in rows if (r[0][name] == v if name == "kind" else r[0][name] <= v)]
            if not left or len(left) == len(rows):
                continue
            right = [r for r in rows if not (r[0][name] == v if name == "kind" else r[0][name] <= v)]
            gain = _leaf(left)[1] + _leaf(right)[1] - whole
            if gain > best[0] + 1e-9:
                best = (gain, name, v)
    return best


def _goes_left(row: dict, name: str, v: int) -> bool:
    return row[name] == v if name == "kind" else row[name] <= v


def _grow(rows: list[tuple], depth: int):
    gain, name, v = _split(rows) if depth else (0.0, None, None)
    if name is None or gain <= 0:
        return RATE * _leaf(rows)[0]
    left = [r for r in rows if _goes_left(r[0], name, v)]
    right = [r for r in rows if not _goes_left(r[0], name, v)]
    return (name, v, _grow(left, depth - 1), _grow(right, depth - 1))


def _value(tree, row: dict) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if _goes_left(row, tree[0], tree[1]) else tree[3]
    return tree


def fit(table: list[dict]) -> tuple[list, dict[int, float]]:
    """Boosted trees of depth 2 with a logistic loss on fold 0, and a threshold per kind from fold 1."""
    table = sorted(table, key=lambda r: (r["fold"], *[r[n] for n in LEVELS]))
    train = [r for r in table if r["fold"] == 0] or table
    test = [r for r in table if r["fold"] == 1] or table
    total, positive = sum(r["n"] for r in train), sum(r["y"] for r in train)
    trees: list = [math.log((positive + 1) / (total - positive + 1))]
    score = [trees[0]] * len(train)
    for _ in range(ROUNDS if train else 0):
        rows = []
        for r, f in zip(train, score, strict=True):
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, f))))
            rows.append((r, r["n"], r["y"] - r["n"] * p, r["n"] * p * (1 - p)))
        tree = _grow(rows, 2)
        if not isinstance(tree, tuple):
            break
        trees.append(tree)
        score = [f + _value(tree, r) for r, f in zip(train, score, strict=True)]

    by_kind: dict[int, list] = defaultdict(list)
    for r in test:
        by_kind[r["kind"]].append((trees[0] + sum(_value(t, r) for t in trees[1:]), r["n"], r["y"]))
    thresholds = {}
    for kind, scored in by_kind.items():
        n = y = 0
        best = math.inf
        for s, rows_n, rows_y in sorted(scored, reverse=True):
            n, y = n + rows_n, y + rows_y
            if n >= SUPPORT and y >= TRUST * n:
                best = s
        thresholds[kind] = best
    return trees, thresholds


def _score(trees: list, c: Column) -> Column:
    def of(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        name, v, left, right = tree
        test = c[name] == v if name == "kind" else c[name] <= v
        return F.when(test, of(left)).otherwise(of(right))

    return reduce(Column.__add__, [of(t) for t in trees])


def select(found: Column, model: tuple[list, dict[int, float]]) -> Column:
    """The spans (start, kind, end) that stay: proved and named ones, and others whose score reaches their kind's threshold."""
    trees, thresholds = model

    def enough(c: Column) -> Column:
        bound = F.lit(math.inf)
        for kind, t in thresholds.items():
            # A strict kind's failing match is no personal data of that kind by definition.
            if kind >= len(STRICT) and t < math.inf:
                bound = F.when(c["kind"] == kind, F.lit(t - 1e-9)).otherwise(bound)
        return c["strict"] | c["evident"] | (_score(trees, c) >= bound)

    return F.transform(F.filter(_apart(found), enough), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``found``, its selected spans sorted by (start, kind, end); kinds are places in ``KINDS``."""
    proposed = materialize(documents(docs).select("doc_id", candidates(F.col("text")).alias("found")), "pii")
    return proposed.select("doc_id", select(F.col("found"), fit(cells(proposed))).alias("found"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every selected span of ``text`` replaced by its kind in brackets; overlapping spans become one.

    A null text stays null. Texts are read twice (once for the cells, once to redact), and never shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    model = fit(cells(docs.select("doc_id", candidates(text).alias("found"))))

    def merge(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        wider = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        apart = (F.size(acc) == 0) | (s["start"] >= last["end"])
        return F.when(apart, F.concat(acc, F.array(s))).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(wider)))

    spans = F.aggregate(select(candidates(text), model), F.array().cast("array<struct<start:int,kind:int,end:int>>"), merge)
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    known = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    parts = F.zip_with(F.slice(ends, 1, F.size(spans)), spans, lambda at, s: F.concat(F.substring(text, at + 1, s["start"] - at), F.element_at(known, s["kind"] + 1)))
    rest = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
    new = F.when(F.col("text").isNull(), F.lit(None).cast("string")).otherwise(F.concat(F.array_join(parts, ""), rest))
    # The spans are needed only where there may be some.
    return docs.withColumn("text", F.when(text.rlike(r"[0-9@]|[(\[](?:at|AT)[)\]]"), new).otherwise(F.col("text")))


def report(docs: DataFrame) -> DataFrame:
    """The digest of ``find``: counts of the strict kinds, a hash of their spans, all spans as text."""
    n_strict = len(STRICT)

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    strict = F.filter("found", lambda s: s["kind"] < n_strict)
    return find(docs).select("doc_id", *map(count, range(n_strict)), F.sha2(spans_text(strict, KINDS), 256).alias("base_sha256"), spans_text(F.col("found"), KINDS).alias("spans"))
