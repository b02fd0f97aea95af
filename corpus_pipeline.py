"""From raw documents to packed training sequences: five stages, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import boilerplate, minhash, mixture, packing, tiling
from tallyfold.llm.common import DOCUMENT_COLUMNS, documents, table
from tallyfold.session import cut_lineage

#: A document goes when its main language has less than this share of it.
MIN_SHARE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language of at least MIN_SHARE, go.

    The rows themselves travel as the key, so repeated and null ids are no matter.
    """
    model = mixture.learn(docs)
    rows = docs.select(F.struct(*DOCUMENT_COLUMNS).alias("row"), "text")
    judged = mixture.identify(rows, model, key="row")
    return judged.filter((F.col("lang_pred") != mixture.UNDETERMINED) & (F.col("score") >= MIN_SHARE)).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a source repeats over its documents are cut; every document stays.

    Documents of equal text count as one, as copies are for the next stage.
    """
    cut = boilerplate.drop_boilerplate(docs.select(DOCUMENT_COLUMNS), copies=False)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(DOCUMENT_COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id stays."""
    kept = minhash.near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select(DOCUMENT_COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text covers a test item go."""
    keyed = docs.select(F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_key")).alias("row"), "text")
    found = tiling.contaminated(keyed, table(spark, sf_dir, "benchmark"), key="row").select("row").distinct()
    leaks = cut_lineage(found.select(F.col("row.doc_id").alias("leak_id"), F.col("row.text_key").alias("leak_key")))
    same = F.col("doc_id").eqNullSafe(F.col("leak_id")) & (F.xxhash64("text") == F.col("leak_key"))
    return docs.join(leaks, same, "left_anti").select(DOCUMENT_COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their token ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Expectation-maximisation and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
