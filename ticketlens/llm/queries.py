"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, divergence, infill, mixing, near, neighbours, quality, repeats, secrets, toxicity, urls, warc
from .base import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scanned by the rules and by a CRF fitted on a bounded sample."""
    docs = table(spark, sf_dir, "documents")
    return secrets.scanned(docs, secrets.fitted(docs))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document with the verdict of the production policy."""
    return quality.judged(quality.ledger(table(spark, sf_dir, "documents")))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that start in an earlier one."""
    return repeats.deduplicated(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by a model fitted on the training folds."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies."""
    return near.groups(table(spark, sf_dir, "documents"), run=3, percent=85)


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All maximal conversations, rendered."""
    return chat.collapsed(table(spark, sf_dir, "conversations"))


def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block, slot and position in the mix."""
    return mixing.positions(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, revisits resolved, as read back from the archives."""
    return warc.deduplicated(table(spark, sf_dir, "pages"))


def op9_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest 20 of every twentieth vector among all."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded: digests of the ids and of the bytes."""
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, else by a model fitted on the labelled table."""
    model = urls.fitted(spark.createDataFrame(urls.labelled_urls(), "label int, url string"))
    return urls.judged(table(spark, sf_dir, "pages"), model, keep=["page_id"])


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text cut and rebuilt: counts, form and digests."""
    return infill.digests(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of sources of each language, and each source's most divergent terms."""
    return divergence.audited(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_quality_rules": op2_quality_rules,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_toxicity": op4_toxicity,
        "op5_minhash_near_dedup": op5_minhash_near_dedup,
        "op6_chat_formatting": op6_chat_formatting,
        "op7_pfair_mixing": op7_pfair_mixing,
        "op8_warc_revisits": op8_warc_revisits,
        "op9_multiprobe_neighbours": op9_multiprobe_neighbours,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_url_filter": op11_url_filter,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_source_divergence": op13_source_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": quality.ORACLE,
        "op3_substring_dedup": repeats.ORACLE,
        "op6_chat_formatting": chat.ORACLE,
        "op8_warc_revisits": warc.ORACLE,
        "op12_fill_in_middle": infill.ORACLE,
        "op13_source_divergence": divergence.ORACLE,
    }
