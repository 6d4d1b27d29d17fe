"""The registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from phenolith.llm import (
    align, chat, fingerprints, hnsw, html_text, mixing, near_dup, oracles, packing, periodic, quality, repeats, simhash, token_files)
from phenolith.llm.common import read_table

TOKENIZER = "word_bpe_49k.json"
#: Tokenizers A and B of op11.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op4_token_files(spark, read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(read_table(spark, sf_dir, "embeddings"), every=20, k=20, vector="embedding")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.learn(pages))


def op6_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.preference_digest(read_table(spark, sf_dir, "conversations"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicate_digest(read_table(spark, sf_dir, "documents"))


def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digest(read_table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(read_table(spark, sf_dir, "documents"))


def op10_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_digest(read_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment_digest(read_table(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED))


def op12_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(read_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_best_fit_packing, op2_quality_classifier, op3_nearest_neighbours, op4_token_files, op5_main_text,
        op6_preference_pairs, op7_near_duplicates, op8_repeated_strings, op9_fingerprints, op10_entropy_balancing,
        op11_token_alignment, op12_simhash_groups, op13_periodic_runs)
}

ORACLES: dict[str, str] = {"op6_preference_pairs": oracles.OP6, "op7_near_duplicates": oracles.OP7}
