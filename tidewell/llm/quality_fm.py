"""Quality classifier: a factorisation machine over hashed words, binned structure
statistics and metadata.

The pairwise part is scored in linear time: for each factor, half of the squared sum
less the sum of squares. Training runs on a bounded sample of labelled rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, batch_words, forget, small_batches, trim

#: Hash buckets of the words.
WORDS = 1 << 14
#: Bins of a structure statistic.
BINS = 12
#: Upper edges of the bins, by statistic.
EDGES = {
    "words": [1, 4, 8, 16, 32, 64, 128, 512, 2048, 8192, 32768],
    "word_bytes": [2, 3, 3.5, 4, 4.5, 5, 6, 7, 9, 12, 20],
    "upper": [0.002, 0.01, 0.02, 0.03, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9],
    "digit": [0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.8],
    "symbol": [0.0005, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.12, 0.2, 0.3, 0.5],
    "punctuation": [0.005, 0.01, 0.02, 0.03, 0.04, 0.06, 0.08, 0.12, 0.2, 0.3, 0.5],
    "line": [0.0005, 0.001, 0.002, 0.003, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4],
    "distinct": [0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.95],
    "top": [0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.6, 0.8],
    "repeated_pairs": [0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.6, 0.8],
}
#: Features: word buckets, statistic bins, and three of the n_chars column (missing, agrees, differs).
FEATURES = WORDS + BINS * len(EDGES) + 3
FACTORS = 8


def _classes() -> np.ndarray:
    """A bit for each kind of byte: upper case, digit, symbol, punctuation, line end."""
    table = np.zeros(256, np.uint8)
    for bit, chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>{}[]^~=_\\@", b".,;:!?\"'()-", b"\n")):
        table[list(chars)] |= 1 << bit
    return table


_CLASSES = _classes()


def features(words: np.ndarray, data: np.ndarray, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one document: unit-length log counts of words, ones for the bins."""
    n = max(len(words), 1)
    distinct, counts = np.unique((words >> np.uint64(50)).astype(np.int64), return_counts=True)
    weight = np.log1p(counts)
    weight /= max(np.sqrt((weight**2).sum()), 1e-9)
    kinds = np.bincount(_CLASSES[data], minlength=32) if len(data) else np.zeros(32, np.int64)
    size = max(len(data), 1)
    share = [kinds[(np.arange(32) >> b) & 1 == 1].sum() / size for b in range(5)]
    exact = len(np.unique(words))
    pairs = words[:-1] * np.uint64(0x9FB21C651E98DF25) + words[1:]
    again = 1 - len(np.unique(pairs)) / len(pairs) if len(pairs) else 0.0
    stats = (len(words), size / n, *share[:5], exact / n, counts.max() / n if len(counts) else 0, again)
    bins = [WORDS + j * BINS + int(np.searchsorted(edges, x, "right")) for j, (edges, x) in enumerate(zip(EDGES.values(), stats, strict=True))]
    chars = int(np.count_nonzero((data & 0xC0) != 0x80))
    meta = FEATURES - 3 + (0 if n_chars is None else 1 if n_chars == chars else 2)
    return np.concatenate([distinct, bins, [meta]]), np.concatenate([weight, np.full(len(bins) + 1, 0.3)])


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[at] * x[:, None]
        return float(self.bias + self.linear[at] @ x + 0.5 * ((v.sum(0) ** 2).sum() - (v * v).sum()))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 1_000, rate: float = 0.15, decay: float = 1e-5, seed: int = 7, batch: int = 64) -> Machine:
    """At least ``steps`` Adagrad steps of ``batch`` rows on the logistic loss, in whole passes of a fixed order; one class or no rows gives a constant score."""
    rng = np.random.default_rng(seed)
    bias, linear, factors = 0.0, np.zeros(FEATURES), rng.normal(0, 0.02, (FEATURES, FACTORS))
    if len(labels) and 0 < labels.mean() < 1:
        bias = float(np.log(labels.mean() / (1 - labels.mean())))
        g_linear, g_factors, g_bias = np.full(FEATURES, 1e-2), np.full((FEATURES, FACTORS), 1e-2), 1e-2
        for _ in range(-(-steps * batch // len(rows))):
            order = rng.permutation(len(rows))
            for lo in range(0, len(order), batch):
                part = order[lo : lo + batch]
                at = np.concatenate([rows[i][0] for i in part])
                x = np.concatenate([rows[i][1] for i in part])
                sizes = np.array([len(rows[i][0]) for i in part])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                v = factors[at] * x[:, None]
                sums = np.add.reduceat(v, starts)
                z = bias + np.add.reduceat(linear[at] * x, starts) + 0.5 * ((sums**2).sum(1) - np.add.reduceat((v * v).sum(1), starts))
                error = np.repeat(1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part], sizes)
                touched, where = np.unique(at, return_inverse=True)
                d_linear = np.bincount(where, error * x, len(touched)) / len(part) + decay * linear[touched]
                slope = (error * x)[:, None] * (np.repeat(sums, sizes, 0) - v)
                d_factors = np.stack([np.bincount(where, slope[:, f], len(touched)) for f in range(FACTORS)], 1) / len(part) + decay * factors[touched]
                d_bias = float((error[starts]).mean())
                g_linear[touched] += d_linear**2
                g_factors[touched] += d_factors**2
                g_bias += d_bias**2
                linear[touched] -= rate * d_linear / np.sqrt(g_linear[touched])
                factors[touched] -= rate * d_factors / np.sqrt(g_factors[touched])
                bias -= rate * d_bias / np.sqrt(g_bias)
    elif len(labels):
        bias = 6.0 if labels.mean() == 1 else -6.0
    return Machine(bias, linear.astype(np.float32), factors.astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, sample: int = 8_000) -> Machine:
    """Fit on at most ``sample`` labelled rows (those with the least hash of doc_id).

    ``labels`` has doc_id and label (0 or 1); null labels and ids are skipped, and of several labels of a
    document the least counts. The sample's ids are few by that bound, so they are broadcast.
    """
    known = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    picked = known.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(sample).select(F.col("doc_id").alias("_id"), "label")
    rows = docs.select("doc_id", "text", "n_chars").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "n_chars", "label")

    def run(batch):
        chars = batch.column("n_chars").to_pylist()
        found = [features(words, data, chars[i]) for i, words, _, data in batch_words(batch, "text")]
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "n": [len(a) for a, _ in found], "h": [zlib.crc32(a.tobytes() + x.tobytes()) for a, x in found], "at": [a for a, _ in found], "x": [x for _, x in found]}

    table = arrow_map(rows, run, "doc_id long, label int, n long, h long, at array<int>, x array<double>").toArrow().sort_by([("doc_id", "ascending"), ("n", "ascending"), ("h", "ascending")])
    at, x = (table.column(c).combine_chunks() if table.num_rows else None for c in ("at", "x"))
    pairs = [(at[i].values.to_numpy().astype(np.int64), x[i].values.to_numpy()) for i in range(table.num_rows)]
    labels = table.column("label").to_numpy().astype(float) if table.num_rows else np.zeros(0)
    machine = fit(pairs, labels)
    del table, at, x, pairs
    forget()
    return machine


def score(spark: SparkSession, docs: DataFrame, machine: Machine, keep: float | None = None) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, n_chars) whose score is ``keep`` or more; without ``keep``: doc_id and score.

    A score is a probability; empty and null texts get one too, from the bins of their sizes.
    """
    sent = spark.sparkContext.broadcast(machine)

    def scores(batch):
        chars, out = batch.column("n_chars").to_pylist(), np.zeros(batch.num_rows)
        for i, words, _, data in batch_words(batch, "text"):
            out[i] = sent.value.margin(*features(words, data, chars[i]))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))

    if keep is None:
        return arrow_map(docs.select("doc_id", "text", "n_chars"), lambda b: {"doc_id": b.column("doc_id"), "score": scores(b)}, "doc_id long, score double")

    def each(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(scores(batch) >= keep))
        trim()

    small_batches(spark)
    return docs.mapInArrow(each, docs.schema)
