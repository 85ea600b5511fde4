"""The registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import chat, decontaminate, duplicate_oracle, licenses, lm_scores, mixing, near, prefix_trie, quality, repeats, sharding, spelling, token_counts, toxicity
from riskspark.llm.runtime import prepare
from riskspark.session import materialize
from riskspark.sources.tables import parquet_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(parquet_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(parquet_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(
        parquet_table(spark, sf_dir, "documents"), parquet_table(spark, sf_dir, "benchmark")
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(parquet_table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of four words, as the query's contract has them."""
    docs = parquet_table(spark, sf_dir, "documents")
    return near.near_duplicates(docs, near.NearRules(shingle=4))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models learn from all documents."""
    return lm_scores.scores(
        parquet_table(spark, sf_dir, "documents"),
        parquet_table(spark, sf_dir, "labels"),
    )


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more whose texts hold control strings."""
    names = ("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)],
        "conv_id long, turn long, role string, text string",
    )
    rows = parquet_table(spark, sf_dir, "conversations").select(*names).unionByName(more)
    return chat.read_back(chat.chat_windows(rows))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(parquet_table(spark, sf_dir, "documents")).drop("spans")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(
        parquet_table(spark, sf_dir, "documents"), parquet_table(spark, sf_dir, "labels")
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(parquet_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(parquet_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with the heads of their families."""
    rows = prefix_trie.sequences(parquet_table(spark, sf_dir, "conversations"))
    seqs = materialize(rows, "conversation-turns")
    return prefix_trie.prefix_trie(prefix_trie.with_family_heads(seqs))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.number(parquet_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    """Each query by name, on a prepared session."""

    def shipped(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return query(spark, sf_dir)

        return run

    return {q.__name__: shipped(q) for q in (op1_license_scan, op2_quality_rules, op3_decontamination, op4_source_mixing, op5_minhash_near_dedup, op6_lm_scores, op7_chat_formatting, op8_suffix_dedup, op9_toxicity, op10_token_counts, op11_spelling_variants, op12_prefix_trie, op13_sharding)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": licenses.oracle_sql(),
        "op2_quality_rules": quality.ORACLE,
        "op5_minhash_near_dedup": duplicate_oracle.near_duplicates_sql(),
        "op8_suffix_dedup": duplicate_oracle.repeats_sql(),
        "op11_spelling_variants": spelling.oracle_sql(),
        "op12_prefix_trie": prefix_trie.oracle_sql(),
        "op13_sharding": sharding.oracle_sql(),
    }
