"""A corpus pipeline over ``documents``: reject, clean, deduplicate, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.  :func:`run` writes each result as Parquet
into the shared folder and reads it again for the next stage.  There is no checking SQL: learned rules and tokenizers are
beyond it; the stages are tested against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import byte_bpe, ngram_groups, quality_lists, site_lines, source_mix
from strataflow.llm.common import stored


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from ``labels``."""
    return quality_lists.keep_good(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that more than a fifth of their source's texts carry, and without lines of 40 or more characters
    that ten or more of them carry; one text keeps each line, and copies as a whole are left to the next stage.
    """
    return site_lines.clean_documents(docs, share=0.2, least_pages=5, long_line=40, least_texts=10)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of word 5-grams are at least 0.8 similar."""
    return ngram_groups.one_of_each(docs, ngram_groups.Rule(words=5, above=4, below=5))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by temperature weights: each document at least once, small sources up to twice."""
    return source_mix.mix_documents(docs, most_passes=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every drawn document, with the result of the round trip."""
    return byte_bpe.encoded_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", reject_bad),
    ("line_dedup", drop_boilerplate),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
