"""The corpus pipeline: toxicity, near-duplicates, decontamination, personal data, tokens.

Each stage is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinloom.llm import decontam, pieces, pii, toxicity, weighted_minhash
from coinloom.llm.common import table
from coinloom.operators.scratch import scratch_root

TOKENIZER = "piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or model scores below 0.5; it learns from labels outside the held-out rows."""
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    return toxicity.reject_toxic(docs, toxicity.train(table(spark, sf_dir, "documents"), labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, one row of it.

    Rows without an id stay one for each text whose whole group has no id.
    """
    kept = weighted_minhash.near_duplicates(docs).filter("kept").select("doc_id", "class_id").distinct()
    named = docs.join(kept.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    nameless = (
        docs.filter("doc_id is null")
        .withColumn("_class", weighted_minhash.nameless_class(F.coalesce("text", F.lit(""))))
        .join(kept.filter("doc_id is null").select(F.col("class_id").alias("_class")), "_class", "left_semi")
        .dropDuplicates(["_class"])
        .drop("_class")
    )
    return named.unionByName(nameless)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    return pii.mask_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256, covered_bytes, ids` of every document."""
    return pieces.digest_documents(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal_data", mask_personal_data),
    ("tokens", encode),
]

# The stages learn, hash and align; SQL expresses none of the first three.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    base = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
