"""A corpus pipeline of training-data operators: each stage takes the documents that the one
before kept and returns documents; the last returns their encoding."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import byte_bpe, language_id, minhash, mixing, pii
from assayer.llm.common import shared_folder


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told.  The network learns from their own ``lang``;
    null texts and texts without a letter go."""
    named = language_id.with_language(docs, language_id.fit(docs))
    return named.where(F.col("lang_pred") != language_id.UNKNOWN).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one of least id."""
    return minhash.without_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by their weights: a row per document and time it is taken."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, the token ids, and whether decoding them gives the text back."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    given = docs.select("doc_id", "source", "lang", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    kept = ["doc_id", "source", "lang", "sha256"]
    done = byte_bpe.encoded(given, path, public_tokenizers.PATTERN, keep=kept, also=("decoded", "packed"))
    same = F.sha2("decoded", 256) == F.col("sha256")
    return done.select(
        "doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", languages),
    ("minhash", near_copies),
    ("pii", personal_data),
    ("mixing", mixed),
    ("byte_bpe", tokens),
]

#: Learned languages, hashed signatures and byte pairs are beyond SQL; tests/llm runs the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read back."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
