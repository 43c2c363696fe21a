"""Registered queries of this subpackage: ``QUERIES`` and ``ORACLES``.

Each query applies one operator, with its production parameters, to the whole of
its table and returns the full result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ledgerline.llm import bpe, decontaminate, host_rules, html_text, lang_id, lexical, pseudonyms, quality, quotes, secrets, simhash
from ledgerline.llm import url_vocabulary, vector_codes
from ledgerline.llm.common import table

BPE_FILE = "byte_bpe_50k.json"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.query(table(spark, sf_dir, "documents"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.query(table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(table(spark, sf_dir, "documents"))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.query(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.query(table(spark, sf_dir, "pages"))


def op8_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.query(table(spark, sf_dir, "conversations"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.query(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_vocabulary.query(table(spark, sf_dir, "pages"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.query(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_language_id, op3_host_rules, op4_bpe_round_trip,
                                   op5_simhash, op6_pseudonyms, op7_main_text, op8_quotations, op9_quality, op10_secrets, op11_lexical_search,
                                   op12_url_vocabulary, op13_vector_codes)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES: dict[str, str] = {"op3_host_rules": host_rules.ORACLE_SQL, "op8_quotations": quotes.ORACLE_SQL,
                           "op11_lexical_search": lexical.ORACLE_SQL, "op12_url_vocabulary": url_vocabulary.ORACLE_SQL,
                           "op13_vector_codes": vector_codes.ORACLE_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
