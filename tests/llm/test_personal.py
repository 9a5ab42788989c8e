"""Identifiers next to one another are found one by one."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("terrace.llm")

from terrace.llm import personal  # noqa: E402


def test_an_identifier_beside_a_fixed_form_is_discovered(spark):
    texts = [f"please write to {n}@mail.example.com today" for n in ("ann", "bob", "cy", "dan", "eve")] + [
        "please write to ann@mail.example.com zoe@intranet today",
        "please write to zoe@intranet ann@mail.example.com kim@desk today",
        "please write to max@intranet lea@desk today",
        "please write to (ann@mail.example.com),x1 zoe@intranet today",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = personal.find_personal_data(docs).select("doc_id", "text", "all_spans").collect()
    found = {r.doc_id: [(s.kind, r.text[s.start : s.end]) for s in r.all_spans] for r in got}
    seed = ("email", "ann@mail.example.com")
    assert found[5] == [seed, ("context_email", "zoe@intranet")]
    assert found[6] == [("context_email", "zoe@intranet"), seed, ("context_email", "kim@desk")]
    assert found[7] == [("context_email", "max@intranet"), ("context_email", "lea@desk")]
    assert found[8] == [seed, ("context_email", "zoe@intranet")]


def test_runs_are_cut_at_seeds(spark):
    text = "call +49 30 12345678 a1 b2@c 3 4, x@y@z.example.com 5 now"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = sorted((r.start, r.end, r.item, list(r.kinds)) for r in personal.candidates(docs, "doc_id", "text").collect())
    want = [("+49 30 12345678", ["phone"]), ("a1", []), ("b2@c", []), ("3 4,", []), ("y@z.example.com", ["email"]), ("5", [])]
    assert [(text[a:b], item, kinds) for a, b, item, kinds in got] == [(item, item, kinds) for item, kinds in want]


def test_columns_of_any_name_come_back(spark):
    schema = "doc_id long, text string, n_chars long, _row string, _found_id long, content long, more string, base_spans string, all_spans int, `x.y` int, _masked string"
    rows = [(i, t, len(t or ""), "r", 7, 8, "m", "b", 9, 1, "k") for i, t in enumerate(["write to a@b.org now", "nothing here", None, "", "call +1 (599) 555-3756"])]
    docs = spark.createDataFrame(rows + rows[:1], schema)
    got = personal.masked_documents(docs)
    assert got.columns == docs.columns
    found = sorted(map(tuple, got.collect()))
    want = []
    for row in rows + rows[:1]:
        text = {0: "write to [EMAIL] now", 4: "call [PHONE]"}.get(row[0], row[1])
        want.append((row[0], text, len(text) if row[0] in (0, 4) else row[2], *row[3:]))
    assert found == sorted(want)
    kept = personal.find_personal_data(docs)
    assert kept.columns == [c for c in docs.columns if c not in ("base_spans", "all_spans")] + ["base_spans", "all_spans"]
    assert personal.masked_documents(docs.limit(0)).count() == 0
