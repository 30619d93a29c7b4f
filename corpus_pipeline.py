"""The corpus pipeline: stages over `documents`, each one of the operators of
`parcelstack.llm`, written as Parquet and reread between stages.

Every stage but the last returns the columns of `documents`. Null and empty
texts leave at the first stage (they have no language); an empty table passes
through as one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstack.llm import exact_dedup, jaccard_join, language_id, mixing, sentencepiece_codec
from parcelstack.llm.queries import model_path
from parcelstack.session import ensure_checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: learns from the labelled rows; documents without an
    identified language go (without any label to learn from, those without a
    letter)."""
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.keep_identified(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of equal texts the document with the largest id stays."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near copies one document stays."""
    return jaccard_join.keep_representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: sources mixed to their target weights; a row per document
    and pass, with the words taken."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: ids (decimal, joined by one space) with an end id, their
    number, and digests of the ids and of what they decode to."""
    encoded = sentencepiece_codec.encode(docs, model_path(), decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids"),
                          F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# SQL has neither the classifier nor the tokenizer; tests compare run() with
# the stages applied by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents table. Stage tables are written to
    the shared folder of the session (spark.checkpoint.dir)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
