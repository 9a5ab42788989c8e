"""A training corpus from raw documents: five stages, each a job whose result is written and read again.

Every stage gets all that the one before it kept. The last stage places the corpus' token ids
in sequences and returns one row per piece; all others return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import mixing, near_duplicates, personal, toxicity, vector_packing
from terrace.llm.queries import TOKENIZER, other_than
from terrace.llm.tables import ship_package, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier scores 0.5 or more go."""
    ship_package(spark)
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"), "toxic", other_than(5, 0))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8), the one with the least id stays."""
    ship_package(spark)
    return near_duplicates.without_near_duplicates(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; ``n_chars`` follows the new text."""
    return personal.masked_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources near their target weights, in whole documents: a document taken twice is two rows."""
    return mixing.mixed_documents(docs, whole=True).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token id of the corpus in one place of one sequence."""
    ship_package(spark)
    return vector_packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Models and heuristics: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
