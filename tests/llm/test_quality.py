"""Quality scores of whole tables: held-out rows, awkward rows, and the model without labels."""

import random
import zlib

import numpy as np
import pytest

pytest.importorskip("terrace.llm")

from terrace.llm import boosted_trees, quality_model  # noqa: E402
from terrace.llm.measures import NAMES, measures_of  # noqa: E402
from terrace.llm.queries import other_than  # noqa: E402
from terrace.llm.tables import ship_package  # noqa: E402

SCHEMA = "doc_id long, text string, label int, score double, _id long, _labelled long, row string"


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(9)
    good = lambda: " ".join(chance.choice("abcdefghij") * chance.randrange(2, 9) + str(chance.randrange(99)) for _ in range(80)) + "."
    bad = lambda: "BUY NOW!!! " * chance.randrange(8, 40) + "$$$ | " * chance.randrange(5, 20)
    made = [(i, good() if i % 3 else bad()) for i in range(240)]
    return made + [(240, None), (241, ""), (242, " \n\t"), (243, "long " * 40_000), made[0], made[1], (None, "a row without an id")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, t, 5, 0.25, 1, 2, "r") for i, t in rows], SCHEMA).repartition(3)


def scored(frame):
    out = {}
    for r in frame.collect():
        assert out.setdefault(r.doc_id, r.score) == r.score and 0 <= r.score <= 1  # repeated rows have equal scores
    return out


def test_held_out_rows_are_told_apart(spark, docs, rows):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), "x") for i in range(240)] + [(None, 1, "x"), (5, None, "x")], "doc_id long, quality int, text string")
    model = quality_model.train_quality(docs, labels, "quality", other_than(3, 1))
    frame = quality_model.quality_scores(docs, model)
    got = scored(frame)
    assert frame.count() == len(rows)
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((got[i] >= 0.5) == (i % 3 > 0) for i in held) >= 0.98 * len(held) > 50
    assert got[240] == got[241]
    again = quality_model.train_quality(docs.repartition(7), labels, "quality", other_than(3, 1))
    assert scored(quality_model.quality_scores(docs, again)) == got
    texts = [t for _, t in rows]
    assert model.score(measures_of(texts)).tolist() == [got[i] for i, _ in rows]  # one at a time or in batches


def test_held_out_labels_change_nothing(spark, docs):
    given = [(i, int(i % 3 > 0)) for i in range(240)]
    turned = [(i, y if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - y) for i, y in given]
    models = [quality_model.train_quality(docs, spark.createDataFrame(x, "doc_id long, quality int"), "quality", other_than(3, 1)) for x in (given, turned)]
    assert scored(quality_model.quality_scores(docs, models[0])) == scored(quality_model.quality_scores(docs, models[1]))


@pytest.mark.parametrize("values, score", [([], 0.5), ([(1, None)], 0.5), ([(900, 1), (901, 0)], 0.5)])
def test_without_labels(spark, docs, values, score):
    labels = spark.createDataFrame(values, "doc_id long, quality int")
    model = quality_model.train_quality(docs, labels, "quality", other_than(3, 1))
    assert set(scored(quality_model.quality_scores(docs, model)).values()) == {score}
    assert quality_model.quality_scores(docs.limit(0), model).count() == 0


def test_flat_trees_score_rows_alike_alone_and_together():
    chance = np.random.default_rng(4)
    x = chance.normal(size=(600, len(NAMES)))
    y = (x[:, 0] + x[:, 3] > 0.3).astype(np.int64)
    model = boosted_trees.train(x, y)
    assert model.score(x).tolist() == [model.score(row[None, :])[0] for row in x]
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95
    assert boosted_trees.train(x, np.ones(600, dtype=np.int64)).score(x[:5]).min() > 0.9
