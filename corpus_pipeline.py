"""The corpus pipeline: documents to packed training sequences, by five of the corpus operators.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before left; all but the last
return the columns of ``documents``. ``run`` writes each stage's result below the shared checkpoint folder and
reads it back for the next. Nulls, empty tables and repeated rows: as each operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolith.llm import mixing, near_dup, packing, quality, repeats
from phenolith.llm.common import fresh, materialise

TOKENIZER = "word_bpe_49k.json"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives label 1 (score of 0.3 or more)."""
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.train(labelled, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = fresh(docs, "__score")
    return quality.score(docs, model, into=score).where(F.col(score) >= 0.3).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near-duplicates: five words, similarity 0.8."""
    return near_dup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte in a 200-byte string that stands elsewhere too goes; n_chars follows the text."""
    return repeats.without_repeats(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.repeated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row for each piece of a document, with its place."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", drop_near_copies),
    ("repeated strings", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Training, sketches and tokenizers are beyond SQL: tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
