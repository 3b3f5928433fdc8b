"""Registered queries of the text operators, with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isopleth.llm import align, decontam, langid, licenses, mixing, pii, planes, quality, simhash, substring, toxicity, trie, warc
from isopleth.llm.common import table
from isopleth.llm.twins import TWINS


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in pii.KINDS]
    digest = F.sha2(pii.span_text("base").cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), pii.span_text("spans").alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_cascade(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), sentences=True)
    places = F.expr("array_join(transform(offending, s -> concat(s.start, ':', s.end)), ',')")
    return found.withColumn("offending", places)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_amounts(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.share_openings(trie.encode_turns(table(spark, sf_dir, "conversations"))))


def op12_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.round_trip(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_language_id,
        op3_simhash,
        op4_decontamination,
        op5_quality,
        op6_toxicity,
        op7_mixing,
        op8_warc,
        op9_license_scan,
        op10_substring,
        op11_prefix_trie,
        op12_token_planes,
        op13_token_alignment,
    )
}
ORACLES: dict[str, str] = TWINS
