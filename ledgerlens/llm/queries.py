"""The registered queries: each applies its operator to the whole table and derives digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.workspace import fresh_folder

from . import (bestposition, bpe, dialogue, hilbert, jaccardjoin, licenses, maxscore, merges, quality, rules, simhash,
               suffixdedup, wavelet)
from .common import documents, reach


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licences(documents(spark, sf_dir))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "token-files")
    wavelet.write(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), folder)
    return wavelet.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (rules.judge(documents(spark, sf_dir), labels(spark, sf_dir))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (hilbert.pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))
            .select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"))


def op5_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    reach(spark)
    return maxscore.top(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (suffixdedup.remove_repeats(spark, documents(spark, sf_dir))
            .select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                    F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(spark, documents(spark, sf_dir), labels(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merges.token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (bpe.encode(documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"))
            .select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256")))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (simhash.near_duplicates(spark, documents(spark, sf_dir))
            .select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dialogue.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    found = dialogue.repair(spark, rows)
    digests = found.messages.where("role IS NULL").select(F.col("conv_id").alias("c"), F.col("sha256").alias("repaired_sha256"))
    return found.conversations.join(digests, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


def op12_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestposition.rank(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccardjoin.join(spark, documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_token_files, op3_quality_rules, op4_packing, op5_maxscore,
                                   op6_suffix_dedup, op7_quality_classifier, op8_token_counts, op9_byte_bpe,
                                   op10_simhash_dedup, op11_conversation_repair, op12_best_position, op13_jaccard_join)}
#: DuckDB SQL where it can express the query.
SQL: dict[str, str] = {"op5_maxscore": maxscore.SQL, "op12_best_position": bestposition.SQL}
