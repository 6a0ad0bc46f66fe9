"""From raw documents to token files: language, near duplicates, benchmark leaks, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's documents.
Null, empty and repeated rows go through every stage as its operator defines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from changeflow.llm import decontaminate, language, mixing, near_dedup, token_files
from changeflow.llm.common import written
from changeflow.plans.tables import read

LEAST_LANGUAGE_SCORE = 0.4  # below it a text is no text of one known language


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; those without letters and those that it is unsure of go."""
    model = language.learn(docs, F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) != 0)
    tagged = language.identify(docs, model, pred_col="__lang", score_col="__score")
    return tagged.where((F.col("__lang") != language.UNKNOWN) & (F.col("__score") >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    return near_dedup.keep_one(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    found = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"), matches_col="__matches", shortest=1)
    return found.where(F.size("__matches") == 0).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.apply_mix(docs)


def token_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as written to and read back from token files."""
    path = token_files.new_path(spark)
    token_files.write_token_files(docs, path, "word_bpe_49k.json", end_id=1)
    return token_files.read_token_files(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near duplicates", one_of_each_group),
    ("benchmark leaks", without_leaks),
    ("source mix", mixed),
    ("token files", token_blocks),
]

# SQL has no byte network, no ProbMinHash and no tokenizer; tests hold run() against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
