"""A training corpus from raw documents: five stages of the llm subpackage, each over all that the one before it kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import mixing, neardup, pieces, secrets, toxicity
from larkspur.llm.common import free_name, remove, scratch, shared_folder, spread, table
from larkspur.llm.queries import TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from these documents and labels, gives less than an even chance of being toxic.

    Null and empty texts score as no evidence does and stay; repeated rows stay or go together; no documents give none.
    """
    score = free_name(docs, "score")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, score).where(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more.

    Null and empty texts are like no other and stay; of rows that repeat key and text one stays; no documents give none.
    """
    return neardup.unique(docs, neardup.Settings())


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, repeated ones too, with secrets masked in their texts and n_chars counted anew; null texts stay null."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, not at all, once or twice; null and empty texts, of no words, not at all. Null sources are one source, repeated rows are taken apart."""
    prefix = free_name(docs, "mix")
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    mixed = mixing.mix(docs, prefix=prefix)
    return mixed.withColumn(f"{prefix}_turn", F.explode(F.array_repeat(F.lit(1), F.col(f"{prefix}_copies").cast("int")))).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip of each row, repeated ones too; null texts have no ids, like empty ones."""
    return pieces.encode(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("secret_scans", mask_secrets), ("source_mixing", mix_sources), ("sentencepiece", encode)]

#: SQL can express neither the learned classifier nor the random rounding; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each one's rows kept as Parquet in the shared folder until the next one's are there.

    What a stage materialises on its way is removed with it. The folder that the last stage reads stays, since its rows are asked for later.
    """
    docs, old = spread(table(spark, sf_dir, "documents")), None
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{k}")
        docs = spark.read.parquet(path)
        if old:
            remove(spark, old)
        old = path
    return STAGES[-1][1](spark, docs, sf_dir)
