"""Collocations against counting by hand."""

import random
import re
from collections import Counter

import pytest

pytest.importorskip("terrace.llm")

from pyspark.sql import functions as F  # noqa: E402

from terrace.llm import collocations as c  # noqa: E402
from terrace.llm.tables import ship_package  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, size int, tail boolean, key long"


def by_hand(rows, least, best, longest):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {x: n for x, n in f.items() if n >= least}
    inside = {}
    for (lang, p), n in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i : i + k]] = max(n, inside.get((lang, p[i : i + k]), 0))
    out = {}
    for (lang, p), a in often.items():
        if len(p) > 1 and inside.get((lang, p), 0) < a:
            cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], total[lang]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n, -score)
        for lang, found in out.items() for rank, (score, a, p, left, right, n) in enumerate(sorted(found)[:best], 1)
    )


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(4)
    vocabulary = [*"abcdefgh", "Éa", "z😀", "x" * 50]
    passage = "one two three four five six seven eight nine ten"
    out = [(None, "en"), ("", None), (" \t \n", "en"), ("!?", ""), ("word", "en"), ("tab\tword  two", None)]
    for i in range(150):
        words = chance.choices(vocabulary, k=chance.randrange(1, 40))
        text = " ".join(w + chance.choice(["", "", "", ",", ".", "\n", "\t", " ", "\r\x0b", " q"]) for w in words)
        out.append((text, chance.choice(["en", "en", "de", "", None, "und"])))
    out += [(f"before {passage}, x x x x x x x x {passage} after a b", "en")] * 6
    out += [("the " + " the ".join(f"r{i}x{j}" for j in range(20)), "en") for i in range(10)]
    return out


@pytest.fixture(scope="module")
def documents(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, t, lang, "p", 1, 2, True, 3) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(4).cache()


@pytest.mark.parametrize("least, best, longest, bits", [(5, 2000, 5, 26), (2, 2000, 5, 20), (6, 7, 4, 15), (3, 2000, 3, 16)])
def test_equal_to_counting_by_hand(documents, rows, least, best, longest, bits):
    got = sorted(tuple(r) for r in c.collocations(documents, least, best, longest, bits).collect())
    assert got == by_hand(rows, least, best, longest) and got


def test_small_holdings_and_colliding_bitmaps_change_nothing(documents, rows, monkeypatch):
    monkeypatch.setattr(c, "HELD", 20)  # in the driver only: workers take their own, the split of tasks differs below
    got = sorted(tuple(r) for r in c.collocations(documents.repartition(13), 4, 50).collect())
    assert got == by_hand(rows, 4, 50, 5)


def test_unary_paths_are_whole_passages(documents):
    *_, paths = c.phrase_graph(documents, least=5)
    found = {(r.lang, " ".join(r.words)): r.n for r in paths.where(F.size("words") > 5).collect()}
    assert found["en", "one two three four five six seven eight nine ten"] == 12
    every = paths.select(F.explode(F.transform(F.sequence(F.lit(0), F.size("words") - 5), lambda i: F.array_join(F.slice("words", i + 1, 5), " "))).alias("e"), "lang")
    assert every.count() == every.distinct().count() and {r.e for r in every.collect()} >= {"one two three four five", "x x x x x"}


def test_no_texts_no_phrases(spark, documents):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert c.collocations(documents, least=10**6).count() == 0


def test_large_counts_are_exact(spark):
    counts = spark.createDataFrame([("en", 1, "a", 10**15 + 7), ("en", 1, "b", 10**15 + 1), ("en", 2, "a b", 10**15)], "lang string, size int, phrase string, a long")
    totals = spark.createDataFrame([("en", 9 * 10**15 + 11)], "lang string, n long")
    row = c.scored(counts.where("size = 2"), counts, totals, 5).first()
    assert row.score == 1000 * 10**15 * (9 * 10**15 + 11) // ((10**15 + 7) * (10**15 + 1))
