"""From documents to packed training sequences: five stages, each written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.llm import langid, packing, simhash, substring, toxicity
from mostrador.llm.common import written
from mostrador.llm.queries import labels

#: A text goes if it has no letter, or fits a second language as well as the best (0.5: no margin at all). The bound does
#: not depend on how many languages were learned.
MIN_LANGUAGE_SCORE = 0.51


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language. A null text or one without a letter goes."""
    judged = langid.predict(docs, langid.train(docs))
    return judged.where(langid.confident(MIN_LANGUAGE_SCORE)).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, does not find toxic."""
    judged = toxicity.score(docs, toxicity.train(docs, labels(spark, sf_dir)))
    return judged.where(toxicity.acceptable()).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the smallest id."""
    return simhash.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words and more that a document with a smaller id has; n_chars follows the text.
    A document of which nothing is left goes."""
    cut = substring.deduplicate(docs)
    cut = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    changed = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", changed).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids (little-endian unsigned 32-bit)."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("substring", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: Learned models, hashes and the tokenizer are not for SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
