"""A training corpus from ``documents``: five stages, each written and read again.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but
the last return the columns of ``documents``; what a stage decides shows in
its rows: toxic documents and near copies are gone, and secrets are masked. The
last returns the encoded corpus. Files read again have no order, so the encoded
corpus says where each document comes in the mix: the schedule follows from the set of rows alone,
whatever files they are in.

Defined cases: a stage takes an empty table, null texts and repeated rows as
its operator does (see their modules); further columns of ``docs`` pass
through all but the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketlens.llm import bpe, mixing, near, secrets, toxicity
from ticketlens.llm.base import table, written

#: Near copies share this much of their runs of so many words, at least; ``op5``'s own figures hold for that query only.
NEAR_RUN, NEAR_PERCENT = 5, 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel SVM does not reject."""
    return toxicity.filtered(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: ``NEAR_RUN``-word runs, ``NEAR_PERCENT`` of a hundred in common."""
    return near.deduplicated(docs, NEAR_RUN, NEAR_PERCENT)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.redacted(docs, secrets.fitted(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the Pfair mix of their sources."""
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded: digests of the ids and of the bytes, with ``slot``, ``in_block`` and ``position`` in the mix."""
    # Encoded first: what is shuffled for the positions are digests, not texts.
    coded = written(bpe.round_trip(docs, keep=("source",)), "encoded")
    return mixing.positions(coded).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "lossless", "slot", "in_block", "position"
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]

#: The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
