"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from trustlens.llm import (centroids, decontaminate, divergence, extract, fingerprints, licenses, linedup, neardup, packing, pii, quality, repeats,
                           urls)
from trustlens.llm.common import table


def op1_best_fit_packing(spark, sf_dir):
    """Place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_pii(spark, sf_dir):
    """Spans of personal data in every document."""
    return pii.report(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark, sf_dir):
    """Benchmark words and items found in every document."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_minhash_near_dedup(spark, sf_dir):
    """Component of near-duplicates of every document."""
    return neardup.link(table(spark, sf_dir, "documents"))


def op5_repeated_bytes(spark, sf_dir):
    """Bytes of every document that lie in a 200-byte string occurring elsewhere."""
    return repeats.report(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark, sf_dir):
    """Lines of every document that repeat or nearly repeat an earlier one."""
    return linedup.report(table(spark, sf_dir, "documents"))


def op7_license_scan(spark, sf_dir):
    """Licences that a document, its paragraphs or its lines state."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark, sf_dir):
    """Counts and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op9_url_filter(spark, sf_dir):
    """Host, path, rule and verdict of every page."""
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op10_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages"))


def op11_document_fingerprints(spark, sf_dir):
    """Fingerprint of every document and of its edited text, their likeness, and near classes."""
    return fingerprints.report(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark, sf_dir):
    """Divergence of every two sources of a language, and the terms that set a source apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark, sf_dir):
    """Cluster of every vector after ten exact rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_pii, op3_benchmark_decontamination, op4_minhash_near_dedup, op5_repeated_bytes,
    op6_line_dedup, op7_license_scan, op8_quality_rules, op9_url_filter, op10_html_extraction,
    op11_document_fingerprints, op12_source_divergence, op13_centroid_clustering)}
ORACLES = {"op3_benchmark_decontamination": decontaminate.ORACLE,
           "op4_minhash_near_dedup": neardup.ORACLE,
           "op7_license_scan": licenses.ORACLE,
           "op8_quality_rules": quality.ORACLE, "op9_url_filter": urls.ORACLE,
           "op12_source_divergence": divergence.ORACLE, "op13_centroid_clustering": centroids.ORACLE}
