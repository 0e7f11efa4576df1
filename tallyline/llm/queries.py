"""The registered queries of the subpackage and their SQL twins: thin, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.llm import (
    backoff_lm,
    collocations,
    neighbour_graph,
    order_minhash,
    paragraph_dedup,
    periodic_runs,
    piece_codec,
    quality,
    secret_ledger,
    simhash_gray,
    source_mix,
    suffix_dedup,
    toxicity,
)
from tallyline.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_ledger.secret_scan(table(spark, sf_dir, "documents"))
    base = [rule.kind for rule in secret_ledger.BASE_RULES]
    findings = F.col("findings")

    def count(kind: str):
        return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(secret_ledger.span_text(findings, base), 256).alias("base_sha256"),
        secret_ledger.span_text(findings).alias("spans"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeated_units(table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.self_scores(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_gray.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash_gray.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def encoded_digests(documents: DataFrame) -> DataFrame:
    """Number and digest of the ids, and digest of the decoded text."""
    import public_tokenizers

    encoded = piece_codec.encode_decode(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_graph.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(documents, quality.train(documents, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(quality.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_periods(table(spark, sf_dir, "documents")))
    best = periodic_runs.strongest(F.col("runs"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best")[name].alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.runs_text(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scans": op1_secret_scans,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_lm_scoring": op3_lm_scoring,
        "op4_source_mix": op4_source_mix,
        "op5_simhash": op5_simhash,
        "op6_toxicity": op6_toxicity,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_neighbours": op8_neighbours,
        "op9_fingerprints": op9_fingerprints,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_quality": op11_quality,
        "op12_collocations": op12_collocations,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scans": secret_ledger.oracle(),
        "op3_lm_scoring": backoff_lm.oracle(),
        "op4_source_mix": source_mix.oracle(),
        "op10_suffix_dedup": suffix_dedup.oracle(),
        "op12_collocations": collocations.oracle(),
    }
