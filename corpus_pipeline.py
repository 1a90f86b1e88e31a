"""A training corpus from raw documents: five stages, each written as Parquet and read again.

Every stage works on all rows that the one before kept. Null texts count as empty, null ids
and repeated rows are allowed; documents' own columns stay as they are until the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import decontaminate, exact_dedup, jaccard_join, packing, toxicity
from paddock.llm.queries import TOKENIZER, new_folder, table, toxicity_model


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go (score 0.3 or more)."""
    return toxicity.drop_toxic(docs, toxicity_model(spark, sf_dir))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the least id stays."""
    return exact_dedup.drop_duplicates(docs)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five words, 0.8), the one with the least id stays."""
    return jaccard_join.drop_near_duplicates(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 4096 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", keep_clean),
    ("exact_dedup", keep_first),
    ("jaccard_join", keep_distinct),
    ("decontaminate", keep_uncontaminated),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = new_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
