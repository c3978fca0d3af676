"""Registered queries of the training-data operators: each applies one
operator with its production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starflow.llm import (decontaminate, exact_dedup, filter_audit, html_extract, importance, lz_fingerprint, ngram_join,
                          packing, pii, quality, secret_scan, token_counts, wavelet)
from starflow.llm.sql import ORACLE_SQL  # noqa: F401
from starflow.session import share_code


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return share_code(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op2_token_shards(spark, sf_dir):
    return wavelet.encode_to_shards(spark, _table(spark, sf_dir, "documents"))


def op3_secret_scan(spark, sf_dir):
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op5_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_html_extract(spark, sf_dir):
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op7_personal_data(spark, sf_dir):
    return pii.find(_table(spark, sf_dir, "documents"))


def op8_quality(spark, sf_dir):
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark, sf_dir):
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_lz_fingerprint(spark, sf_dir):
    return lz_fingerprint.edited_likeness(_table(spark, sf_dir, "documents"))


def op12_importance(spark, sf_dir):
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_shards": op2_token_shards,
    "op3_secret_scan": op3_secret_scan,
    "op4_token_counts": op4_token_counts,
    "op5_packing": op5_packing,
    "op6_html_extract": op6_html_extract,
    "op7_personal_data": op7_personal_data,
    "op8_quality": op8_quality,
    "op9_ngram_join": op9_ngram_join,
    "op10_decontaminate": op10_decontaminate,
    "op11_lz_fingerprint": op11_lz_fingerprint,
    "op12_importance": op12_importance,
    "op13_filter_audit": op13_filter_audit,
}
