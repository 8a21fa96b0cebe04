"""Plain-Python statements of what the queries must return."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest(spans, order):
    return sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted((a, order.index(k), k, b) for k, a, b in spans)))


def secrets(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if 2 * d > 9 else 2 * d)
    return total % 10 == 0


def personal(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words),
    }


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def jaccard_components(rows):
    """doc_id -> (set size, smallest reachable doc_id), by comparing all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    by_set = {}
    for d, s in sets.items():
        by_set.setdefault(s, []).append(d)
    keys = [s for s in by_set if s]
    for s in keys:
        for d in by_set[s]:
            parent[root(d)] = root(by_set[s][0])
    where = {}
    for k, s in enumerate(keys):
        for x in s:
            where.setdefault(x, []).append(k)
    for k, s in enumerate(keys):
        common = Counter(j for x in s for j in where[x] if j > k)
        for j, n in common.items():
            if 100 * n >= 85 * (len(s) + len(keys[j]) - n):
                parent[root(by_set[s][0])] = root(by_set[keys[j]][0])
    least = {}
    for d in sets:
        least[root(d)] = min(d, least.get(root(d), d))
    return {d: (len(sets[d]), least[root(d)]) for d in sets}


def substring_dedup(rows, width=13):
    """doc_id -> (n_words, n_removed, kept_sha256)."""
    words = {d: WORD.findall(t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - width + 1):
            first.setdefault(tuple(words[d][i : i + width]), d)
    out = {}
    for d, ws in words.items():
        gone = set()
        for i in range(len(ws) - width + 1):
            if first[tuple(ws[i : i + width])] < d:
                gone.update(range(i, i + width))
        out[d] = (len(ws), len(gone), sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out
