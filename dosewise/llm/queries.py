"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import ann_tree, merkle, mixing, oracles, packing, pii, quality_fm, runs, secret_scan, simhash, topk, toxicity, url_rules, wordpiece
from .common import table


def op1_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_quality_fm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_fm.score_quality(docs, quality_fm.learn(docs, table(spark, sf_dir, "labels")))


def op3_pii(spark, sf_dir):
    return pii.digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op4_ann_kmeans_tree(spark, sf_dir):
    return ann_tree.nearest(table(spark, sf_dir, "embeddings"))


def op5_best_fit_packing(spark, sf_dir):
    return packing.pack_apart(table(spark, sf_dir, "documents"))


def op6_url_rules(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op7_source_mixing(spark, sf_dir):
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op8_toxicity_pu(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op9_token_counts(spark, sf_dir):
    return wordpiece.token_counts(table(spark, sf_dir, "documents"))


def op10_exact_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secret_scan.digest(secret_scan.find_secrets(docs, secret_scan.learn(secret_scan.labelled_findings(docs))))


def op12_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return runs.digest(runs.periodic_runs(docs.select("doc_id", runs.folded(F.col("doc_id"), F.col("text")).alias("text"))))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.report(merkle.manifest(merkle.leaves(table(spark, sf_dir, "documents"), merkle.tampered_rows())))


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_quality_fm, op3_pii, op4_ann_kmeans_tree, op5_best_fit_packing,
    op6_url_rules, op7_source_mixing, op8_toxicity_pu, op9_token_counts, op10_exact_topk,
    op11_secret_scan, op12_periodic_runs, op13_merkle_manifest,
)}

ORACLES = {"op6_url_rules": oracles.OP6, "op7_source_mixing": oracles.OP7, "op10_exact_topk": oracles.OP10, "op13_merkle_manifest": oracles.OP13}
