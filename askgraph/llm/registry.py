"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askgraph.llm import (
    binary, byte_bpe, covertree, filter_audit, merkle, mixing, packing, pii, secrets_scan, simhash, substrings,
    top_k, toxicity,
)
from askgraph.llm.common import new_path, table


def op1_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_best_fit(table(spark, sf_dir, "documents"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op5_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = binary.packed_matrices(table(spark, sf_dir, "documents"))
    return binary.digest(binary.write_matrices(packed, new_path(spark, "matrices")))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.exact_top_k(
        table(spark, sf_dir, "embeddings"), is_query=F.pmod("vec_id", F.lit(20)) == 0
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_cover_tree,
        op2_best_fit_packing,
        op3_substrings,
        op4_mixing,
        op5_token_matrices,
        op6_secret_scan,
        op7_exact_top_k,
        op8_simhash,
        op9_toxicity,
        op10_personal_data,
        op11_merkle_manifest,
        op12_filter_audit,
        op13_byte_bpe,
    )
}

ORACLES: dict[str, str] = {
    "op1_cover_tree": covertree.SQL,
    "op3_substrings": substrings.SQL,
    "op7_exact_top_k": top_k.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_filter_audit": filter_audit.SQL,
}
