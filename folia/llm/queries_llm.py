"""Registered queries of the text operators; pN_ runs over the whole tables of problem N."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folia.llm import leakage, lookalike, markup, mojibake, scanned, tokenize
from folia.sources.tables import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.found(table(spark, sf_dir, "project_regions"), table(spark, sf_dir, "source_selectors"), table(spark, sf_dir, "sources"))


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.cleaned_all(table(spark, sf_dir, "project_regions"), table(spark, sf_dir, "source_selectors"), table(spark, sf_dir, "sources"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.same_look(table(spark, sf_dir, "project_regions"))


def p3_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.normalized(table(spark, sf_dir, "project_regions"), id_col="id", text_cols=["source_text", "ocr_text"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned.defects(table(spark, sf_dir, "project_regions"))


def p5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned.paragraphs(table(spark, sf_dir, "project_regions"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.encode_texts(table(spark, sf_dir, "documents"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.restored(table(spark, sf_dir, "documents"), id_col="doc_id", with_text=False).select("doc_id").distinct()


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.restored(table(spark, sf_dir, "documents"), id_col="doc_id")


QUERIES = {f.__name__: f for f in (p2_found, p2_clean, p3_found, p3_normalized, p5_found, p5_paragraphs, p6_ids, p7_found, p8_found, p8_restored)}
SQL: dict[str, str] = {}
