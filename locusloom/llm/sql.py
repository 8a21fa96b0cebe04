"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from . import chat_format, secret_scan

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_scan() -> str:
    """Base matches are leftmost and not overlapping; ones with a short value are dropped after matching."""
    each = []
    for kind, rule in enumerate([*secret_scan.RULES, secret_scan.RULES[0]]):
        inside = kind == len(secret_scan.RULES)
        value = rule.whole.removeprefix(rule.head).replace("++", "+") if rule.head and not inside else None
        pattern = _quoted(f"{rule.head}({value})" if value else rule.pattern)
        values = f"regexp_extract_all(text, {pattern}, 1)" if value else "NULL"
        name = secret_scan.INSIDE if inside else rule.name
        each.append(
            f"SELECT doc_id, {kind} AS kind, '{name}' AS name, {rule.least if value else 0} AS least, regexp_extract_all(text, {pattern}) AS found, "
            f"{values} AS vals, string_split_regex(text, {pattern}) AS gaps FROM d"
        )
    n_base, n_inside = len(secret_scan.BASE_RULES), len(secret_scan.RULES)
    counts = ", ".join(f"count(*) FILTER (kind = {k}) AS n_{r.name}" for k, r in enumerate(secret_scan.BASE_RULES))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(each)}),
s AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m WHERE len(found) > 0),
p AS (SELECT doc_id, kind, name,
             CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a,
             length(found[i]) AS n FROM s WHERE vals IS NULL OR length(vals[i]) >= least),
t AS (SELECT doc_id, kind, a, concat(name, ':', a, ':', a + n) AS span FROM p
      WHERE kind < {n_inside} OR NOT EXISTS (SELECT 1 FROM p q WHERE q.kind = 0 AND q.doc_id = p.doc_id AND q.a = p.a))
SELECT d.doc_id, {counts},
       sha256(coalesce(string_agg(span, ',' ORDER BY a, kind) FILTER (kind < {n_base}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY a, kind), '') AS spans
FROM d LEFT JOIN t USING (doc_id) GROUP BY d.doc_id"""


NGRAM_JOIN = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sized AS (SELECT s.doc_id, shingle, n FROM s JOIN n USING (doc_id)),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sized a JOIN sized b USING (shingle)
  WHERE a.doc_id <> b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (
  SELECT a AS doc_id, b AS other FROM links
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY d.doc_id, n.n"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 12 + 1)) AS i FROM d WHERE len(w) >= 13)),
gone AS (
  SELECT DISTINCT doc_id, i + k AS i
  FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS first FROM windows), range(13) AS r(k) WHERE first < doc_id),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d)
SELECT d.doc_id, len(any_value(d.w)) AS n_words, count(gone.i) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY each.i) FILTER (gone.i IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN each USING (doc_id) LEFT JOIN gone ON gone.doc_id = each.doc_id AND gone.i = each.i GROUP BY d.doc_id"""


def _chat_format() -> str:
    starts = " ".join(f"WHEN '{r}' THEN {len(s)}" for r, s in chat_format.STARTS.items())
    return rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, 'none') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(text) + len(regexp_extract_all(text, '<<SYS>>|<</SYS>>|\[/?INST\]|</?s>')) + length(text) - length(replace(text, chr(8288), ''))
           + CASE role {starts} ELSE {len(chat_format.OTHER)} + length(role) + 1 END + {len(chat_format.END)}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


COLLOCATIONS = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
size AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 5) AS t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.g, c.k, c.f AS a, cut, l.f AS l, r.f AS r, CAST(2000000 * CAST(c.f AS HUGEINT) // (l.f + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1) c
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:cut] JOIN f r ON r.lang = c.lang AND r.g = c.g[cut + 1:]),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, g[i:i + n - 1] AS g, max(f) AS around
  FROM (SELECT lang, g, f, k, n, unnest(range(1, k - n + 2)) AS i FROM f, range(2, 4) AS t(n) WHERE k > n) GROUP BY ALL),
kept AS (
  SELECT s.lang, array_to_string(s.g, ' ') AS phrase, a, l, r, score
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.g = s.g WHERE around IS NULL OR 100 * around < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN size USING (lang) QUALIFY rank <= 2000"""


ORACLES = {
    "op1_secret_scan": _secret_scan(),
    "op5_ngram_join": NGRAM_JOIN,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op7_chat_format": _chat_format(),
    "op12_phrases": COLLOCATIONS,
}
