"""Queries of the text operators over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import crossmatch, encode, leakage, names, reading, residue
from plumbline.session import table


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode(table(spark, d, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return reading.reading_bands(table(spark, d, "documents"), table(spark, d, "reading_labels"), "doc_id", "text")


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "doc_type")
    return p10_found(spark, d).join(docs, "doc_id").groupBy("doc_type", "band").agg(F.count("*").alias("n"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.find_residue(table(spark, d, "descriptions"), "desc_id", "description").select("desc_id")


def p5_kinds(spark: SparkSession, d: str) -> DataFrame:
    return residue.find_residue(table(spark, d, "descriptions"), "desc_id", "description").groupBy("kind").agg(F.count("*").alias("n"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), "doc_id", "text", "item_id", "text")


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    return p9_found(spark, d).groupBy("item_id").agg(F.count("*").alias("n_docs"))


def _greenbook(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "greenbook_enrichment").withColumns({"agency_name": F.col("matched_from.agency_name"), "confidence_score": F.col("matched_from.confidence_score")})


def p2_links(spark: SparkSession, d: str) -> DataFrame:
    """The pairs with their confidence."""
    return crossmatch.match_offices(_greenbook(spark, d), table(spark, d, "agency_contacts"), table(spark, d, "registry"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_links(spark, d).select("enrichment_id", "contact_id")


def p4_links(spark: SparkSession, d: str) -> DataFrame:
    """Each linked row with its posterior."""
    rows, registry = _greenbook(spark, d), table(spark, d, "registry")
    return names.link_variants(rows.where("entity_id is null"), rows.where("entity_id is not null"), registry, "enrichment_id", "agency_name", "entity_id", "id", ["name", "short_name"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_links(spark, d).select("enrichment_id", "entity_id")


QUERIES = {f.__name__: f for f in (p2_found, p2_links, p4_found, p4_links, p5_found, p5_kinds, p9_found, p9_items, p8_ids, p10_found, p10_profile)}
ORACLE: dict[str, str] = {}
