"""Corpus pipeline: STAGES of (name, function), each calling one operator of ``ledgerline.llm``.

A stage takes (spark, docs, sf_dir) and returns the rows that it keeps; all but the last
return the columns of ``documents``.  ``run`` writes every stage's rows as Parquet below the
shared checkpoint folder and reads them back as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, decontaminate, lang_id, pseudonyms, simhash
from ledgerline.llm.common import materialize, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of undetermined language go."""
    return lang_id.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group stays."""
    return simhash.deduplicate(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Validated personal values become pseudonyms."""
    return pseudonyms.pseudonymise(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and the digests of the ids and of the decoded text."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", identify_language), ("near-copies", drop_near_copies), ("benchmark", drop_benchmark),
          ("personal-data", replace_personal_data), ("tokens", encode_tokens)]

#: Learned and iterative stages: no SQL gives these rows; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
