"""The registered queries of this package, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import boilerplate, centroids, factorization, licenses, minhash, mixing, mixture, packing, perplexity, secrets, tiling, transcripts, trie
from tallyfold.llm.common import crc_mod, documents, table
from tallyfold.llm.sql import SQL  # noqa: F401


def op1_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = perplexity.quality(documents(spark, sf_dir))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(*first, "log_perplexity", "lower", "upper")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False).drop("ids")


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_mod("doc_id", 4) == 2
    model = mixture.learn(docs.filter(~held_out))
    return mixture.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "shares")


def op4_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op5_factorization(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_mod("doc_id", 5) == 0
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("toxic").alias("label"))
    model = factorization.learn(docs, labels=labels)
    out = factorization.score(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op7_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", boilerplate.host_of("url").alias("host"), boilerplate.html_text("html").alias("text"))
    return boilerplate.drop_boilerplate(pages, site="host").select("page_id", "host", "n_lines", "n_dropped", "text")


def op8_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return transcripts.recover(turns.drop("role"), transcripts.learn(turns))


def op9_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(documents(spark, sf_dir)))


def op10_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("source")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_perplexity": op1_perplexity,
    "op2_packing": op2_packing,
    "op3_mixture": op3_mixture,
    "op4_tiling": op4_tiling,
    "op5_factorization": op5_factorization,
    "op6_minhash": op6_minhash,
    "op7_site_lines": op7_site_lines,
    "op8_transcripts": op8_transcripts,
    "op9_entropy": op9_entropy,
    "op10_dice": op10_dice,
    "op11_trie": op11_trie,
    "op12_centroids": op12_centroids,
    "op13_mixing": op13_mixing,
}
