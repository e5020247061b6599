"""Language ID: multinomial naive Bayes over hashed character n-grams.

Code points are hashed in numpy, a block of texts at a time, and scored as a sparse matrix; the
log-probability matrix is broadcast.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_fold, arrow_map

#: Hash buckets of the n-grams of 1 to 3 characters.
BUCKETS = 1 << 15
#: Code points scored at once.
BLOCK = 1 << 18


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _hashed(codes: np.ndarray, new: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n-grams of 1, 2 and 3 codes that hold a letter: the places they begin at, and their buckets; only those whose last code is at ``new`` or later."""
    letter, one = codes != 32, codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    two = one[:-1] * np.uint64(3) + (one[1:] ^ np.uint64(0x51ED270B))
    three = two[:-1] * np.uint64(5) + (one[2:] ^ np.uint64(0x2545F491))
    any2 = letter[:-1] | letter[1:]
    any3 = any2[:-1] & (letter[1:-1] | letter[2:])
    out = []
    for n, (x, good) in enumerate(((one, letter), (two, any2), (three, any3))):
        at = np.flatnonzero(good[max(new - n, 0) :]) + max(new - n, 0)
        out.append((at, (x[at] * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(49)).astype(np.int64)))
    return out


def blocks(texts: list[str | None]):
    """(row, bucket) of all n-grams of the texts, rows rising, in blocks of bounded size.

    What isn't a letter counts as a gap, gaps in a row as one, and a text begins and ends with a gap. Short texts come many to a block; a long one
    comes in pieces that overlap by two codes, so that no n-gram is lost or made up where it is cut.
    """
    held, size = [], 0
    for row, text in enumerate(texts):
        if text and len(text) > BLOCK:
            yield from _long(row, text.lower())
        elif text:
            held.append((row, text.lower()))
            size += len(text)
            if size >= BLOCK:
                yield from _short(held)
                held, size = [], 0
    if held:
        yield from _short(held)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _short(held: list[tuple[int, str]]):
    rows = np.repeat([r for r, _ in held], [len(t) for _, t in held])
    codes = _codes("".join([t for _, t in held]))
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (rows[1:] == rows[:-1])
    codes, rows = np.where(letter, codes, np.uint32(32))[keep], rows[keep]
    # Two gaps stand between texts, which no n-gram with a letter on both sides spans.
    names, order = np.unique(rows, return_inverse=True)
    place = np.arange(len(rows)) + 2 * order + 1
    out = np.full(len(rows) + 2 * len(names), 32, np.uint32)
    out[place] = codes
    of = np.empty(len(out), np.int64)
    of[place] = rows
    first = np.concatenate([[0], np.flatnonzero(rows[1:] != rows[:-1]) + 1]) if len(rows) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(rows)]]) - 1 if len(rows) else first
    of[place[first] - 1], of[place[last] + 1] = names, names
    for at, bucket in _hashed(out, 0):
        yield of[at], bucket


def _long(row: int, text: str):
    carry, new, before = np.full(1, 32, np.uint32), 0, False
    for lo in range(0, len(text), BLOCK):
        codes = _codes(text[lo : lo + BLOCK])
        letter = _letters()[codes]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= before
        before = bool(letter[-1])
        codes = np.concatenate([carry, np.where(letter, codes, np.uint32(32))[keep], np.full(1 if lo + BLOCK >= len(text) else 0, 32, np.uint32)])
        for _, bucket in _hashed(codes, new):
            yield np.full(len(bucket), row), bucket
        carry = codes[-2:]
        new = len(carry)


@dataclass
class Bayes:
    """Languages, log-probabilities of buckets by language, and of the languages themselves."""

    langs: list[str]
    logs: np.ndarray
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """A batch at once: each block's (row, bucket) pairs are a sparse matrix of counts, whose product with the logs is a sum of their rows."""
        total, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for row, bucket in blocks(texts) if self.langs else ():
            if len(row):
                first = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1])
                total[row[first]] += np.add.reduceat(self.logs[bucket], first)
                n[row[first]] += np.diff(np.append(first, len(row)))
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        # Neighbouring n-grams overlap, so the evidence is tempered before it is made a probability.
        z = (total + self.prior) / (1 + np.sqrt(n))[:, None]
        p = np.exp(z - z.max(1, keepdims=True))
        best = z.argmax(1)
        score = p[np.arange(len(p)), best] / p.sum(1)
        return [self.langs[b] if k else "und" for b, k in zip(best.tolist(), n.tolist(), strict=True)], np.where(n > 0, score, 0.0).tolist()


def train(docs: DataFrame, sample: int = 4_000, smooth: float = 0.1) -> Bayes:
    """Fit on about ``sample`` rows of each language of ``docs`` (doc_id, text, lang) with text and lang: those whose hash of doc_id lies below the language's share.

    Priors are the languages' shares of all rows. Ties of languages go to the first by name. No rows at all: every text is ``und``.
    """
    rows = docs.where("text is not null and lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    if not sizes:
        return Bayes([], np.zeros((BUCKETS, 0)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))])
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * float(1 << 30)).select("text", "lang")
    langs = sorted(sizes)

    def run(batches):
        counts = np.zeros((len(langs), BUCKETS), np.int64)
        for batch in batches:
            of = np.searchsorted(langs, batch.column("lang").to_pylist())
            for row, bucket in blocks(batch.column("text").to_pylist()):
                counts += np.bincount(of[row] * BUCKETS + bucket, minlength=counts.size).reshape(counts.shape)
        lang, bucket = np.nonzero(counts)
        return {"lang": lang.astype(np.int32), "b": bucket.astype(np.int32), "c": counts[lang, bucket]}

    counts = arrow_fold(rows, run, "lang int, b int, c long").groupBy("lang", "b").agg(F.sum("c").alias("c")).toPandas()
    table = np.full((BUCKETS, len(langs)), smooth)
    table[counts["b"].to_numpy(int), counts["lang"].to_numpy(int)] += counts["c"].to_numpy(float)
    share = np.array([sizes[x] for x in langs], float)
    return Bayes(langs, np.log(table) - np.log(table.sum(0)), np.log(share / share.sum()))


def identify(spark: SparkSession, docs: DataFrame, model: Bayes) -> DataFrame:
    """doc_id, lang_pred and score for every row; null texts and texts without a letter give ``und`` and 0."""
    sent = spark.sparkContext.broadcast(model)

    def run(batch):
        names, scores = sent.value.predict(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "lang_pred": names, "score": scores}

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")
