"""The mix in whole documents."""

import random
from collections import Counter

import pytest

pytest.importorskip("terrace.llm")

from terrace.llm import mixing  # noqa: E402

SCHEMA = "doc_id long, text string, source string"


def test_whole_documents_near_the_targets(spark):
    chance = random.Random(8)
    rows = [(i, "\n".join(f"w{i} x  y" for _ in range(chance.choice([0, 1, 5, 60]))), f"s{i % 4}") for i in range(120)]
    rows += [(200 + i, f"alone  {i}\nits second line\n" + "more " * 20 * i, f"one{i}") for i in range(9)] + [rows[7], rows[9]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    longest, taken, target = Counter(), Counter(), {}
    for _, t, s in rows:
        longest[s] = max(longest[s], len(t.split()))
    source = {d: s for d, _, s in rows}
    counted = Counter()
    for r in mixing.mix(docs, whole=True).collect():
        assert all(d.words == r.size for d in r.draws) and r.taken == r.size * len(r.draws) and 0 <= r.taken <= 3 * r.size
        taken[source[r.mixed_id]] += r.taken
        target[source[r.mixed_id]] = r.target
        counted[r.mixed_id] += len(r.draws)
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 0.5 for s in target) and len(target) == 13
    given = {d: t for d, t, _ in rows}
    got = mixing.mixed_documents(docs, whole=True).collect()
    assert all(r.text == given[r.doc_id] for r in got)
    assert Counter(r.doc_id for r in got) == +counted


def test_pieces_follow_each_other_and_names_do_not_clash(spark, monkeypatch):
    schema = "doc_id long, text string, source string, _row int, _draw string, size string, draws int, words long, _text string, _source string, `a.b` int"
    rows = [(i, f"w{i} " * (i % 50), f"s{i % 3}" if i % 7 else None, i, "d", "s", 1, 2, "t", "x", i) for i in range(300)] + [(300, None, "s0", 1, "d", "s", 1, 2, "t", "x", 5)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    made = {}
    for words in (1 << 24, 400):
        monkeypatch.setattr(mixing, "PIECE_WORDS", words)
        parts = mixing.mixed_documents(docs, shards=4, whole=True)
        assert parts.columns == docs.columns
        made[words] = parts.rdd.glom().collect()
    whole, cut = made.values()
    pieces = len(cut) // 4
    assert len(whole) == 4 and pieces == -(-sum(len((r[1] or "").split()) for r in rows) // 1600) > 1
    for shard in range(4):
        assert [r for part in cut[shard * pieces : (shard + 1) * pieces] for r in part] == whole[shard]
    assert max(map(len, cut)) < max(map(len, whole))
    by_id = {r[0]: r for r in rows}
    assert all(tuple(r) == by_id[r.doc_id] for part in whole for r in part)


def test_blocks_follow_the_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c", "s") for i in range(500)], SCHEMA)
    monkeypatch.setattr(mixing, "BLOCKS", 2)
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 10)
    rows = mixing.mix(docs, whole=True).collect()
    assert len(rows) == 500 and sum(r.taken for r in rows) == 1500
    assert mixing.mixed_documents(docs.limit(0), whole=True).count() == 0
