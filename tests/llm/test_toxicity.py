"""What the toxicity stage keeps when nothing could be learned."""

import pytest

pytest.importorskip("terrace.llm")

from terrace.llm import toxicity  # noqa: E402
from terrace.llm.tables import ship_package  # noqa: E402


@pytest.mark.parametrize("labels", [[], [(1, None), (2, None)], [(77, 1), (78, 0)]], ids=["no rows", "null values", "other ids"])
def test_without_usable_labels_every_document_stays(spark, labels):
    ship_package(spark)
    rows = [(1, "a clean text"), (2, "you idiot"), (3, None), (4, ""), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic", lambda c: c.isNotNull())
    assert sorted(map(str, toxicity.without_toxic(docs, model).collect())) == sorted(map(str, docs.collect()))


def test_an_empty_table_has_no_scores(spark):
    ship_package(spark)
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = toxicity.train_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"), "toxic", lambda c: c.isNotNull())
    assert toxicity.toxicity_scores(docs, model).count() == 0 and toxicity.without_toxic(docs, model).count() == 0
