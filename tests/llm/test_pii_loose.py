"""Personal data that no strict rule sees."""

from __future__ import annotations

from locusloom.llm import pii

TEXTS = {
    1: ("write to john (at) example (dot) com soon", "write to [MAIL_WORDS] soon"),
    2: ("call me, ssn 123-45-6789 ok", "call me, ssn [PERSON_ID] ok"),
    3: ("please call 555-123-4567 now", "please call [LOCAL_PHONE] now"),
    4: ("part 123-45-6789 of lot 555-123-4567", None),
    5: ("mail a@b.cd", "mail [EMAIL]"),
}


def test_loose_kinds_are_redacted_where_they_are_evident(spark):
    docs = spark.createDataFrame([(d, t) for d, (t, _) in TEXTS.items()], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert got == {d: new or old for d, (old, new) in TEXTS.items()}
    spans = {r.doc_id: (r.n_email, r.n_phone, r.spans) for r in pii.report(docs).collect()}
    assert spans[1][:2] == (0, 0) and "mail_words:9:36" in spans[1][2]
    assert "person_id:13:24" in spans[2][2] and "local_phone:12:24" in spans[3][2] and spans[4][2] == ""


def test_trees_choose_what_no_rule_names_and_refuse_the_rest(spark):
    """Named numbers teach what the surroundings of unnamed ones look like."""
    number = lambda k: f"{200 + k % 700}-{100 + k * 7 % 900}-{1000 + k * 13 % 9000}"
    person = lambda k: f"{100 + k % 800}-{10 + k % 80}-{1000 + k * 17 % 9000}"
    named = [f"you can call me at {number(k)} today" for k in range(300)]
    unnamed = [f"better reach me at {number(k + 5)} today" for k in range(40)]
    parts = [f"we sell the part {number(k + 9)} cheaply" for k in range(300)]
    person_named = [f"my ssn is {person(k)} today" for k in range(15)]
    person_parts = [f"we ship the part {person(k)} cheaply" for k in range(200)]
    texts = named + unnamed + parts + person_named + person_parts
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    has = lambda group, kind: [kind in kept[texts.index(t)] for t in group]
    assert all(has(named, "local_phone")) and all(has(person_named, "person_id"))  # by their names
    assert all(has(unnamed, "local_phone"))  # by the trees alone
    assert not any(has(parts, "local_phone")) and not any(has(person_parts, "person_id"))
    redacted = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert redacted[len(named)] == "better reach me at [LOCAL_PHONE] today"
    assert redacted[len(named) + len(unnamed)] == parts[0]


def test_no_second_names_for_strict_spans(spark):
    docs = spark.createDataFrame([(k, f"pay 4111 1111 1111 1111 or call +1 555 {100 + k} 4567") for k in range(60)], "doc_id long, text string")
    spans = [r.spans for r in pii.report(docs).collect()]
    assert all({s.split(":")[0] for s in x.split(",")} == {"card", "phone"} for x in spans)
