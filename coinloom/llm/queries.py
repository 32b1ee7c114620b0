"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinloom.llm import (
    cap_filters, chaining, chat, decontam, frames, lexical, oracles, packing, pieces, pii, sharding, toxicity, weighted_minhash, wrappers,
)
from coinloom.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_documents(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digest(chat.format_windows(turns.unionByName(probe)))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.vector_links(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_text(table(spark, sf_dir, "pages"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passage_rows(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_minhash.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.digest_outputs(frames.fill_in_middle(frames.store_frames(table(spark, sf_dir, "documents"))))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=10)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces_of = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)
    return packing.pack(pieces_of, capacity=2048)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_sharding": op2_sharding,
    "op3_decontamination": op3_decontamination,
    "op4_embeddings": op4_embeddings,
    "op5_html": op5_html,
    "op6_substrings": op6_substrings,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_chat": op8_chat,
    "op9_minhash": op9_minhash,
    "op10_toxicity": op10_toxicity,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_lexical_search": op12_lexical_search,
    "op13_packing": op13_packing,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op2_sharding": oracles.SHARDING,
    "op4_embeddings": oracles.EMBEDDINGS,
    "op8_chat": oracles.CHAT,
    "op11_fill_in_middle": oracles.FILL_IN_MIDDLE,
    "op12_lexical_search": oracles.LEXICAL_SEARCH,
}
