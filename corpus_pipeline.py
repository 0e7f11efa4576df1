"""A corpus pipeline of the training-data operators: each stage reads what the one before has kept.

Defined results, by the rules of the operators: a NULL text counts as empty and passes like one; of repeated rows and of near
copies one row stays, of rows without an id, too; a NULL source is a source of its own; empty tables give no rows; columns that the stages
do not name are kept up to the last one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import secret_ledger, simhash_gray, source_mix, toxicity
from tallyline.llm.queries import encoded_digests
from tallyline.llm.tables import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the least id."""
    return simhash_gray.drop_near_copies(docs)


def mark_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; no document goes."""
    return secret_ledger.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are there as often as their source's target asks: not at all, once or twice."""
    return source_mix.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, as their number and digests."""
    return encoded_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", mark_secrets),
    ("source_mix", mix_sources),
    ("encoding", encode),
]

# The classifier, XXH64 and the encoder have no SQL form: tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
