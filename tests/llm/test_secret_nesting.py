"""A dropped base match uses up its text; what begins inside is a kind of its own."""

from __future__ import annotations

import brute

from locusloom.llm import secret_scan

TEXTS = [
    "token: password: hunter2hunter2",
    "é token=secret 'api_key' = \"abcdefghijkl\" password:passwd=ABCDEFGHIJKLM",
    "secret: token: secret=abcdefghijkl x",
    "password: short token: abcdefghijkl",
]


def test_nested_keywords(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = sorted(secret_scan.report(docs).collect(), key=lambda r: r.doc_id)
    for r, text in zip(rows, TEXTS, strict=True):
        want = brute.secrets(text)
        assert (r.n_assign, r.base_sha256) == (sum(s[0] == "assign" for s in want), brute.digest(want, ["assign", "access", "hex"]))
    assert rows[0].n_assign == 0 and rows[0].spans == "assign_inside:7:31"
    assert rows[3].spans == "assign:16:35"


def test_the_sql_states_the_same(spark):
    import duckdb

    from locusloom.llm.sql import ORACLES

    docs = spark.createDataFrame(list(enumerate([*TEXTS, None, "plain"])), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = sorted(con.execute(ORACLES["op1_secret_scan"]).fetchall())
    assert sorted(tuple(r) for r in secret_scan.report(docs).collect()) == want
