"""The operators of this subpackage as queries over whole tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postmill.llm import class_lm, decontaminate, flac, language_id, pieces, quality_gam, secrets, simhash, substrings, url_filter
from postmill.llm.common import read_table


def piece_model() -> str:
    """Where the public vocabulary of 32,000 pieces is installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.site_report(read_table(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))


def op4_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.media_report(read_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_texts(read_table(spark, sf_dir, "documents"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.drop_repeats(read_table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_report(read_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(read_table(spark, sf_dir, "documents"), piece_model())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_flac": op4_flac,
    "op5_simhash": op5_simhash,
    "op6_class_lm": op6_class_lm,
    "op7_substrings": op7_substrings,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_pieces": op10_pieces,
}

ORACLE: dict[str, str] = {
    "op1_url_filter": url_filter.ORACLE,
    "op2_decontamination": decontaminate.ORACLE,
    "op7_substrings": substrings.ORACLE,
    "op8_secrets": secrets.ORACLE,
}
