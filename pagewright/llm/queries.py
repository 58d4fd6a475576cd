"""Queries of the training-data operators, by name; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .p1_repeated import repeated_lines, without_repeated_lines
from .p2_lookalikes import disguised_terms
from .p3_quality import not_prose
from .p4_sentences import sentence_ends, sentence_units, sidebar_lines, standalone_items
from .p5_repair import faults, repaired_paragraphs
from .p6_packing import fill_report, packed
from .p7_mixing import mixture, shares_reached
from .p8_levels import level_profile, reading_levels
from .tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines(table(spark, d, "ocr_lines"), table(spark, d, "regions"), table(spark, d, "books")).select("line_id")


def p1_pages(spark: SparkSession, d: str) -> DataFrame:
    return without_repeated_lines(table(spark, d, "ocr_lines"), table(spark, d, "regions"), table(spark, d, "books"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return disguised_terms(table(spark, d, "ocr_lines"), table(spark, d, "items"), table(spark, d, "terms"), table(spark, d, "lexicon"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    lines, regions, items, books, labels = (table(spark, d, t) for t in ("ocr_lines", "regions", "items", "books", "form_labels"))
    return not_prose(lines, regions, items, books, labels, repeated_lines(lines, regions, books))


def _sentence_texts(spark: SparkSession, d: str) -> DataFrame:
    lines, regions, items, books = (table(spark, d, t) for t in ("ocr_lines", "regions", "items", "books"))
    return standalone_items(items, books).unionByName(sidebar_lines(lines, regions, books))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return sentence_ends(_sentence_texts(spark, d))


def p4_sentences(spark: SparkSession, d: str) -> DataFrame:
    return sentence_units(_sentence_texts(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return faults(*(table(spark, d, t) for t in ("ocr_lines", "regions", "books", "items", "lexicon", "form_labels")))


def p5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return repaired_paragraphs(*(table(spark, d, t) for t in ("ocr_lines", "regions", "books", "items", "lexicon", "form_labels")))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return packed(table(spark, d, "documents"), table(spark, d, "pack_sizes"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return fill_report(p6_containers(spark, d))


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return shares_reached(p7_mixture(spark, d), table(spark, d, "mix_targets"))


def p8_levels(spark: SparkSession, d: str) -> DataFrame:
    return reading_levels(table(spark, d, "documents"), table(spark, d, "level_labels"), table(spark, d, "lexicon"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_levels(spark, d).select("doc_id", "level")


def p8_profile(spark: SparkSession, d: str) -> DataFrame:
    return level_profile(p8_levels(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (p1_found, p1_pages, p2_found, p3_found, p4_found, p4_sentences, p5_found, p5_paragraphs, p6_containers, p6_report, p7_mixture, p7_shares, p8_found, p8_profile)
    return {query.__name__: query for query in made}


def oracle_sql() -> dict[str, str]:
    return {}
