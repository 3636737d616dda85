"""The corpus pipeline: language, exact and near duplicates, mixture, packing.

Every stage works on all that its predecessor kept; each result is written as Parquet and read again. Stages take
(spark, docs, sf_dir) and, but for the last, return the columns of docs.

Defined cases: a row with a null or letterless text goes in the first stage; null ids, sources and other columns stay as they are, a null
language is replaced by the predicted one. Of rows that repeat id and text one stays (exact_dedup); ties go to the smaller id. Texts of any
length are read whole by every stage. Columns besides those of ``documents``, whatever their names, are passed on. An empty table
gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from campanile.llm import exact_dedup, language, mixing, packing, simhash
from campanile.llm.common import read_table, written
from campanile.llm.queries import WEIGHTS, mixture_levels, target_shares

#: Texts of random letters score up to 0.22 from some thirty words on, other scripts 0; documents of the learned languages 0.39 or more.
LEAST_LANGUAGE_SCORE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or unlike every learned language, go; ``lang`` becomes the predicted language, by which sources are mixed.

    Profiles are learned from the named languages; where none is named, only documents without a letter go.
    """
    return language.keep_identified(docs, language.fit(docs), min_score=LEAST_LANGUAGE_SCORE, lang_col="lang")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, similarity 0.8 or more, each found) the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three quarters of the tokens, by weight; a document that two epochs take is there twice."""
    return mixing.mix(docs, mixture_levels(), WEIGHTS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows at the mixture's target shares of the sources."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), weights=target_shares())


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Profiles, fingerprints and token ids can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
