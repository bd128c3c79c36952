"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and reads it
again as the next one's documents. Filtering is one row per document; a dropped document is gone for good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwatch.llm.catalog import TOKENIZER
from stallwatch.llm.decontamination import decontaminate
from stallwatch.llm.neardup import drop_near_duplicates
from stallwatch.llm.packing import pack
from stallwatch.llm.pii import redact_personal_data
from stallwatch.llm.quality_grades import fit_grades, select_documents
from stallwatch.llm.scratch import Scratch, owned_tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier gives good quality, toxic or not, with their own columns. Texts without words, null ones included, go; an empty table gives none."""
    return select_documents(docs, fit_grades(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; documents without words stay. An empty table gives none."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items, with their own columns. Null and empty texts stay; an empty table gives none."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data in their texts replaced; n_chars tells the new length. Null texts stay null; an empty table gives none."""
    return redact_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences; ids_crc32 stands for the ids. A null or empty text is one piece of its end id alone; an empty table gives none."""
    pieces = pack(docs, TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("packing", packing)]
#: The stages learn from labels and decode text: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with owned_tables():  # what the stage writes for itself
            docs = scratch.table(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
