"""The queries of this subpackage, each over its whole table, and their DuckDB counterparts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chunk_dedup,
    conversation_repair,
    decontaminate,
    exact_dedup,
    html_extract,
    jaccard_join,
    neighbours,
    packing,
    sharding,
    spelling,
    suffix_dedup,
    token_output,
    toxicity,
)
from .common import shared_folder
from .oracle import CONVERSATIONS, SPELLING

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("kept").isNull(), 0).otherwise(F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_output.read_tokens(spark, path)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "shards")
    sharding.write_shards(table(spark, sf_dir, "documents"), path, shards=16)
    return sharding.read_shards(spark, path).select(
        "doc_id",
        (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    """Learnt from all labels but those held out."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.fit(table(spark, sf_dir, "documents"), labels.where(~toxicity.held_out(F.col("doc_id"))))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_duplicates(table(spark, sf_dir, "documents")).drop("chain")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = chunk_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.when(F.col("spans").isNull(), 0).otherwise(F.size("spans")).cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    turns = conversation_repair.damaged(given)
    return conversation_repair.summaries(turns, conversation_repair.plan_repairs(turns, given.select("conv_id")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_token_output": op3_token_output,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_sharding": op5_sharding,
    "op6_html_extract": op6_html_extract,
    "op7_toxicity": op7_toxicity,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_packing": op9_packing,
    "op10_chunk_dedup": op10_chunk_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLE: dict[str, str] = {
    "op8_exact_dedup": """
        WITH rows AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, text_sha256
        FROM rows WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op11_conversation_repair": CONVERSATIONS,
    "op12_spelling_variants": SPELLING,
}
