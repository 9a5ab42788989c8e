"""Quality of documents: boosted trees over their statistics.

Measures of whole texts (shares of kinds of characters, repetition, lengths) are taken in
batches with array operations. The trees are trained on a documented, bounded sample of
labelled documents and travel to the tasks as flat arrays; scoring is a map over all rows
without a shuffle.

Defined results: null and empty texts have all measures 0 and get the score of that row.
Null labels are unused. Without labels of both kinds the score is the smoothed share of
label 1, which is 0.5 for none. Repeated rows get equal scores.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.boosted_trees import Trees, train
from terrace.llm.hashing import chunks
from terrace.llm.labelled import MOST_LABELS, collected, labelled_sample
from terrace.llm.measures import NAMES, measures_of


def train_quality(documents: DataFrame, labels: DataFrame, label: str, learn: Column, most_labels: int = MOST_LABELS, doc_id: str = "doc_id", text: str = "text") -> Trees:
    sample = labelled_sample(documents, labels, label, learn, most_labels, doc_id, text)

    def measure(frames):
        for frame in chunks(frames):
            rows = measures_of(frame["text"].tolist())
            yield pd.DataFrame({"id": frame["_id"], "label": frame["label"], "row": [r.tobytes() for r in rows]})

    found = collected(sample.mapInPandas(measure, "id long, label int, row binary"))
    rows = np.array([np.frombuffer(r) for r in found["row"]]).reshape(len(found), len(NAMES))
    return train(rows, found["label"].to_numpy(dtype=np.int64))


def quality_scores(documents: DataFrame, model: Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""

    def score(frames):
        for frame in chunks(frames):
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": model.score(measures_of(frame["text"].tolist()))})

    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(score, "doc_id long, score double")
