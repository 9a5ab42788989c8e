"""A bounded sample of labelled documents, held-out rows left aside."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_LABELS = 20_000


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, learn: Column, most_labels: int, doc_id: str, text: str) -> DataFrame:
    """(text, label) of at most ``most_labels`` labelled documents for which ``learn`` holds, drawn by a hash of the id.

    A document with several labels counts once, with the larger one. The sample's ids are few
    enough to be broadcast: ``most_labels`` is their bound.
    """
    usable = labels.select(F.col("doc_id").alias("_labelled"), F.col(label).cast("int").alias("label")).where("_labelled IS NOT NULL AND label IN (0, 1)")
    chosen = usable.where(learn(F.col("_labelled"))).groupBy("_labelled").agg(F.max("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("_labelled"), "_labelled").limit(most_labels)
    held = documents.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    return held.join(F.broadcast(chosen), F.col("_id") == F.col("_labelled")).select("_id", "text", "label")


def collected(frame: DataFrame) -> pd.DataFrame:
    """At most ``most_labels`` rows of numbers, in an order that does not depend on the run."""
    found = frame.toPandas()
    return found.sort_values(list(found.columns), kind="stable", key=lambda c: c.map(bytes) if c.dtype == object else c).reset_index(drop=True)
