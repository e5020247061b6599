"""A training-corpus pipeline over the documents table: reject low quality, keep one document of
each near-duplicate group, drop benchmark leaks, redact live secrets, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
in the shared folder and reads it again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontam, ngram_join, quality_fm, secrets, sentencepiece_viterbi
from tidewell.llm.common import Scratch, private, read, small
from tidewell.llm.queries import quality_machine, tokenizer

#: Least quality score of a document that stays.
QUALITY = 0.3


def _without(spark: SparkSession, docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but for the listed rows, known by doc_id, null or not, and hash of the text; the list is broadcast only if it is small."""
    id_, th = private("id"), private("th")
    gone = Scratch(spark).keep(gone.select(F.col("doc_id").alias(id_), F.col("th").alias(th)).distinct(), "gone")
    return docs.join(small(gone), F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(th)), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores QUALITY or more."""
    return quality_fm.score(spark, docs, quality_machine(spark, docs, sf_dir), keep=QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least doc_id, those without one last, then the least hash of the text, of each group linked by
    five-word shingles at similarity 0.8, also if rows share an id; repeated rows once."""
    scratch, th = Scratch(spark), F.xxhash64("text").alias("th")
    if docs.groupBy("doc_id", th).count().where("count > 1").limit(1).count():
        docs = docs.dropDuplicates(["doc_id", "text"])
    row = F.xxhash64("doc_id", F.xxhash64("text")).alias("row")
    found = ngram_join.jaccard_components(spark, docs.select(row.alias("doc_id"), "text"), k=5, num=4, den=5)
    others = scratch.keep(found.where("n_shingles > 0 and doc_id <> component_id").select(F.col("doc_id").alias("row"), "component_id"), "others")
    members = scratch.keep(others.unionByName(others.select(F.col("component_id").alias("row"), "component_id").distinct()), "members")
    members = scratch.keep(docs.select("doc_id", th, row).join(small(members), "row"), "named")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first"))
    first = scratch.keep(first.select("component_id", F.col("first.doc_id").alias("_id"), F.col("first.th").alias("_first")), "first")
    gone = members.join(small(first), "component_id").where("not (doc_id <=> _id and th = _first)")
    kept = _without(spark, docs, gone)
    scratch.drop("others", "members", "named", "first")
    return kept


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return _without(spark, docs, decontam.contaminated(spark, docs, read(spark, sf_dir, "benchmark")))


def live_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live credentials in them redacted."""
    return secrets.redact(spark, docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and whether decoding the ids gives the text back."""
    return sentencepiece_viterbi.encode(spark, docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("secret_scans", live_secrets),
    ("sentencepiece", encoded),
]

#: The classifier and the tokenizer can't be expressed in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch, last = read(spark, sf_dir, "documents"), Scratch(spark), None
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last:
            scratch.drop(f"pipeline-{last}")
        last = name
    return docs
