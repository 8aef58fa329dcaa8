"""A corpus from raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import hilbert, quality, rules, simhash, suffixdedup
from ledgerlens.llm.common import documents, reach, renamed, stage
from ledgerlens.llm.queries import labels, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a base rule nor a learned rule rejects, in their own columns."""
    reach(spark)
    keep = tuple(docs.columns)
    return rules.judge(docs, labels(spark, sf_dir), keep=keep).where("kept").select(*renamed(keep))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good, in their own columns."""
    reach(spark)
    keep = tuple(docs.columns)
    return quality.score(spark, docs, labels(spark, sf_dir), keep=keep).where("predicted = 1").select(*renamed(keep))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest doc_id.

    Rows without doc_id belong to no group and stay.  Of rows with one doc_id, one stays for every
    group whose smallest doc_id it is: the one with the smallest text, then the smallest other columns.
    """
    reach(spark)
    found = stage(spark, simhash.grouped(spark, docs).where("doc_id IS NOT NULL"), "simhash-found")
    chosen = found.where("doc_id = component_id")
    kept = docs.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
    repeated = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.limit(1).count():
        keep = ("text", *(c for c in docs.columns if c != "text"))
        rows = simhash.fingerprints(kept.join(repeated, "doc_id", "left_semi"), keep=keep)
        one = (rows.join(chosen.select("doc_id", "bits", "group_id").distinct(), ["doc_id", "bits"])
               .groupBy("doc_id", "group_id").agg(F.min(F.struct(*renamed(keep))).alias("row")))
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(one.select("row.*"))
    if docs.where("doc_id IS NULL").limit(1).count():
        kept = kept.unionByName(docs.where("doc_id IS NULL"))
    return kept.select(*docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that occur earlier; n_chars follows the text that is left."""
    reach(spark)
    keep = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = suffixdedup.remove_repeats(spark, docs, keep=keep, as_text=True)
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept")} | {c: F.col(f"keep_{k}") for k, c in enumerate(keep)}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.size("spans") > 0, F.length("kept").cast("long")).otherwise(columns["n_chars"])
    return cut.select(*(columns[c].alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of at most 1024, with a checksum in place of the ids."""
    reach(spark)
    return (hilbert.pack(docs, vocabulary("byte_bpe_50k.json"))
            .select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"))


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier),
          ("simhash_near_dedup", simhash_near_dedup), ("suffix_array_dedup", suffix_array_dedup), ("packing", packing)]

#: SQL can't express the learned stages; tests compare small results with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(spark, step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
