"""The queries of the numbered operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import context_mixing, decontamination, exact_dedup, html_text, jaccard_join, mixing, pseudonyms, secret_links, token_alignment, token_records, toxicity, url_filter, vector_codes
from .common import table


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_records.token_records(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score_texts(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


#: The session's setting for the key of the pseudonyms, and the key where it is unset: one for public test tables, no secret.
KEY_SETTING, TEST_KEY = "spark.vivarium.pseudonym.key", "key of the public test tables"


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(table(spark, sf_dir, "documents"), spark.conf.get(KEY_SETTING, TEST_KEY))


def op11_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.secret_spans(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_alignment.token_alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_jaccard_join, op2_decontamination, op3_exact_dedup, op4_toxicity, op5_html_text, op6_token_records, op7_url_filter, op8_context_mixing, op9_mixing, op10_pseudonyms, op11_secret_links, op12_vector_codes, op13_token_alignment)}
ORACLE_SQL = {"op1_jaccard_join": jaccard_join.SQL, "op2_decontamination": decontamination.SQL, "op3_exact_dedup": exact_dedup.SQL, "op7_url_filter": url_filter.SQL, "op11_secret_links": secret_links.SQL, "op12_vector_codes": vector_codes.SQL}
