"""Registered queries of this package; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm import (
    archives,
    bpe,
    conversation_trie,
    decontaminate,
    html_text,
    katz,
    licences,
    pii,
    quality_rules,
    simhash,
    sql,
    substring_dedup,
    vector_codes,
    weak_labels,
)
from tillbook.llm.shipping import ship

_BUILDS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(build: Callable[[SparkSession, str], DataFrame]):
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    _BUILDS[build.__name__] = shipped
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of runs that stand in an earlier one."""
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


@registered
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics, base rules and the forest's verdict for every document."""
    found = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


@registered
def op1_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and Katz scores of every document, learned from those that are not held out."""
    return katz.scores(table(spark, sf_dir, "documents"))


@registered
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with the best window of each."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op3_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and the component of fingerprints linked at two bits or fewer."""
    return simhash.fingerprint_components(table(spark, sf_dir, "documents"), k=3, radius=2)


@registered
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base kinds by pattern, identifiers by context."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


@registered
def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or inherited; documents lie in folders by source and language."""
    path = F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), path.alias("path"), "text")
    return licences.scan(files).withColumnRenamed("id", "doc_id")


@registered
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them, as digests."""
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("ids")


@registered
def op9_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak label, score and verdict of every document."""
    return weak_labels.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page without the templates of its site."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@registered
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and error of every embedding."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).drop("label")


@registered
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of conversations that begin like the first one of their family."""
    turns = conversation_trie.sequences(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.with_shared_heads(turns))


@registered
def op13_archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of ARC archives that became WARC archives."""
    records = archives.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_BUILDS)


def oracle_sql() -> dict[str, str]:
    """DuckDB statements where SQL expresses the operator; the others are tested against brute force."""
    return dict(sql.STATEMENTS)
