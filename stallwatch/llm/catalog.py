"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwatch.llm import oracle
from stallwatch.llm.decontamination import contaminated, find_contamination
from stallwatch.llm.lexical_search import search
from stallwatch.llm.neardup import near_duplicates
from stallwatch.llm.order_minhash import fingerprint_documents
from stallwatch.llm.packing import pack
from stallwatch.llm.pii import find_personal_data
from stallwatch.llm.quality_grades import fit_grades, grade_documents
from stallwatch.llm.quality_rules import BASE, apply_quality_rules, fit_quality_rules
from stallwatch.llm.secrets import scan_secrets
from stallwatch.llm.substrings import remove_repeats
from stallwatch.llm.toxicity import fit_toxicity, score_toxicity
from stallwatch.llm.warc import round_trip
from stallwatch.llm.whitening import whiten

#: A vocabulary file installed on every machine.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    items = F.array_join("items", ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), contaminated().alias("contaminated"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents")).select("doc_id", "kind", "start", "end", "value", "coverage", "score", "kept")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "pages")).drop("url")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    trees = fit_quality_rules(docs, _table(spark, sf_dir, "labels"))
    return apply_quality_rules(docs, trees).select("doc_id", *BASE, "base_failed", "kept", "score")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return grade_documents(docs, fit_grades(docs, _table(spark, sf_dir, "labels")), keep=["doc_id"])


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return oracle.SQL
