"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veritally.llm import (
    audit,
    chat,
    decontaminate,
    jaccard,
    language,
    licenses,
    merkle,
    mixing,
    packing,
    pii,
    resampling,
    secrets,
    urls,
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language_id(spark, d):
    return language.document_languages(_read(spark, d, "documents"))


def op2_license_scan(spark, d):
    return licenses.license_matches(_read(spark, d, "documents"))


def op3_token_packing(spark, d):
    return packing.pack(_read(spark, d, "documents"))


def op4_jaccard_join(spark, d):
    return jaccard.document_components(_read(spark, d, "documents"))


def op5_decontamination(spark, d):
    return decontaminate.document_leaks(_read(spark, d, "documents"), _read(spark, d, "benchmark"))


def op6_source_mix(spark, d):
    return mixing.document_mix(_read(spark, d, "documents"))


def op7_url_filter(spark, d):
    return urls.page_verdicts(_read(spark, d, "pages"), _read(spark, d, "labels"))


def op8_personal_data(spark, d):
    return pii.document_personal_data(_read(spark, d, "documents"))


def op9_fingerprints(spark, d):
    return merkle.document_fingerprints(_read(spark, d, "documents"))


def op10_secrets(spark, d):
    return secrets.document_secrets(_read(spark, d, "documents"))


def op11_filter_audit(spark, d):
    return audit.document_audit(spark, f"{d}/documents.parquet", _read(spark, d, "labels"))


def op12_chat_format(spark, d):
    return chat.conversation_digests(_read(spark, d, "conversations"))


def op13_importance_resampling(spark, d):
    return resampling.document_resampling(_read(spark, d, "documents"), _read(spark, d, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_token_packing": op3_token_packing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_decontamination": op5_decontamination,
    "op6_source_mix": op6_source_mix,
    "op7_url_filter": op7_url_filter,
    "op8_personal_data": op8_personal_data,
    "op9_fingerprints": op9_fingerprints,
    "op10_secrets": op10_secrets,
    "op11_filter_audit": op11_filter_audit,
    "op12_chat_format": op12_chat_format,
    "op13_importance_resampling": op13_importance_resampling,
}
