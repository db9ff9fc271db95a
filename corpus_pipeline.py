"""Corpus pipeline: documents through five stages, each written as Parquet and read back.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, with the columns of ``documents`` for all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, mixing, pii, simhash, toxicity
from strata.llm.common import fold_of, pick, read_table, staged
from strata.llm.registry import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar scores 0.5 or more go; all others stay as they are."""
    docs = pick(docs, *COLUMNS)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), fold_of("doc_id") != 0)
    scored = toxicity.score(docs, model, keep=COLUMNS)
    return scored.where(F.col("score") < 0.5).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(pick(docs, *COLUMNS), shingle=4, max_bits=4)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind in brackets."""
    return pii.redact(pick(docs, *COLUMNS), "text", "n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the curriculum takes them: once per pass, in the order of training positions."""
    return mixing.mixed_rows(pick(docs, *COLUMNS), length_col="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids (little-endian unsigned 32-bit) of every row, with digests of the ids and of the decoded text."""
    encoded = bpe.encode(pick(docs, *COLUMNS), tokenizer_path(), keep=("source",), decoded_col="decoded")
    return encoded.select(
        "doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each but the last is written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# the stages are trained models, a similarity join and a tokenizer: tests/llm holds them
# against brute force
ORACLE_SQL = None
