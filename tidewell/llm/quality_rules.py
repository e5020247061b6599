"""Quality rules: plain counts, and a hashed n-gram log-likelihood ratio between a trusted
target and the raw corpus. DataFrame operations only.

Both multinomials live on a fixed number of buckets of hashed words and word pairs, so the
model is a constant of fixed size in the plan and every document is judged without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, small

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
#: Buckets of the multinomials.
BUCKETS = 8192
#: Least length-normalised log-likelihood ratio of a document that is kept.
THRESHOLD = -0.15


def _hashed(docs: DataFrame, *keep: str) -> DataFrame:
    """``docs`` with ``words`` and ``h``, the hash of each; null texts count as empty."""
    words = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text")).withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    return words.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))


def _buckets(h: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    pairs = F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))), F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int"))
    return F.concat(F.transform(h, lambda x: F.pmod(x, F.lit(BUCKETS)).cast("int")), pairs)


@dataclass
class Ratio:
    """log p(bucket | target) - log p(bucket | raw)."""

    logs: list[float]


def trusted(labels: DataFrame, column: str = "quality") -> DataFrame:
    """Ids of the documents labelled 1."""
    return labels.where(F.col(column) == 1).where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def fit(docs: DataFrame, target: DataFrame, smooth: float = 1.0) -> Ratio:
    """Count all of ``docs`` (doc_id, text) as the raw corpus, and those in ``target`` (doc_id) as the target.

    Counts are summed map-side; BUCKETS rows reach the driver. Without target or raw rows all ratios are 0.
    """
    known = small(target.select(F.col("doc_id").alias("_id"), F.lit(1).alias("_t")).distinct())
    marked = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id"), "left")
    rows = _hashed(marked.withColumn("_t", F.coalesce("_t", F.lit(0))), "_t").select("_t", F.explode(_buckets(F.col("h"))).alias("b"))
    counts = np.zeros((2, BUCKETS))
    for row in rows.groupBy("b").agg(F.count("*").alias("raw"), F.sum("_t").alias("target")).collect():
        counts[:, row["b"]] = row["raw"], row["target"]
    if not counts.sum(1).all():
        return Ratio([0.0] * BUCKETS)
    logs = np.log((counts + smooth) / (counts.sum(1, keepdims=True) + smooth * BUCKETS))
    return Ratio(np.round(logs[1] - logs[0], 6).tolist())


def _covered(h: Column) -> Column:
    """Words in 3-word windows found twice or more: the windows' hashes are sorted with their places, equal neighbours give the repeated
    places, and each of those covers what the next one doesn't."""

    def places(sorted_: Column) -> Column:
        again = F.filter(sorted_, lambda s, j: (s["g"] == F.get(sorted_, j - 1)["g"]) | (s["g"] == F.get(sorted_, j + 1)["g"]))
        return F.array_sort(F.transform(again, lambda s: s["i"]))

    def total(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, j: F.least(F.lit(3), F.get(at, j + 1) - p)), F.lit(0), lambda s, v: s + v)

    windows = F.transform(F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
    twice = lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i")))), lambda s: let(places(s), total)))
    return let(windows, twice)


def judge(docs: DataFrame, ratio: Ratio, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, score and verdict of every row of ``docs`` (doc_id, text).

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score (mean log-likelihood
    ratio of the document's words and pairs, 0 without words). Null and empty texts have no words and fail the base
    rules. Repeated rows are judged each; other columns are ignored.
    """
    table = F.split(F.lit(" ".join(map(repr, ratio.logs))), " ").cast("array<double>")
    lines = F.transform(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.xxhash64(x))
    score = let(_buckets(F.col("h")), lambda b: F.aggregate(b, F.lit(0.0), lambda s, v: s + F.element_at(table, v + 1)) / F.greatest(F.size(b), F.lit(1)))
    counted = _hashed(docs, "doc_id").select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", SYMBOL)) - 1).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _covered(F.col("h")).cast("long").alias("n_repeat_words"),
        F.round(score, 6).alias("score"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
