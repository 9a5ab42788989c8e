"""Texts with very many matches: spans as by brute force, masked, and in bounded time."""

import re
import time

import pytest

pytest.importorskip("terrace.llm")

from pyspark.sql import functions as F  # noqa: E402

from terrace.llm import personal  # noqa: E402

MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"


def found(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    shown = personal.find_personal_data(df).select("base_spans", "all_spans", personal.masked(F.col("text"), F.col("all_spans")).alias("masked"))
    row = shown.first()
    return [(s.kind, s.start, s.end) for s in row.base_spans], [(s.kind, s.start, s.end) for s in row.all_spans], row.masked


def test_many_short_numbers(spark):
    start = time.time()
    base, every, masked = found(spark, "w 12 " * 200_000)
    assert base == [] and every == [] and masked == "w 12 " * 200_000
    assert time.time() - start < 240


@pytest.mark.parametrize("between, n", [(" then to ", 20_000), (" ", 4_000), (" é7 ", 4_000)])
def test_many_mails(spark, between, n):
    text = between.join(f"u{i}@h{i % 97}.example.com" for i in range(n))
    start = time.time()
    base, every, masked = found(spark, text)
    assert base == [("email", m.start(), m.end()) for m in re.finditer(MAIL, text)] and len(base) == n
    assert set(base) <= set(every)
    if between != " é7 ":
        assert masked == between.join(["[EMAIL]"] * n)
    assert time.time() - start < 240
