"""The n-gram join against brute force where its long lists, size classes, salts and rounds all come into play."""

import random

import numpy as np
import pytest

from tidewell.llm import ngram_join


def brute(rows, k, num, den):
    sets = {}
    for i, text in rows:
        w = text.lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def texts(seed):
    """Chains of near copies of several lengths, all with one passage, so that posting lists are long and hold many components."""
    rng, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(12)]
    for group in range(14):
        words = passage + [f"g{group}w{i}" for i in range(rng.choice((4, 9, 30, 60)))]
        for _ in range(rng.randint(1, 9)):
            words = list(words)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = [f"n{rng.random()}"] * rng.randint(0, 1)
            rows.append((len(rows) * 3 % 211, " ".join(words)))
    return rows


@pytest.mark.parametrize(("k", "num", "den"), [(3, 9, 10), (5, 4, 5)])
def test_components_are_exact(spark, monkeypatch, k, num, den):
    for name, value in (("SHORT", 1), ("BLOCK", 3), ("REST_PAIRS", 4), ("LISTED", 20), ("COUNTED", 64), ("LEAST", 2)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = texts(k)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(spark, docs, k, num, den).collect()}
    assert got == brute(rows, k, num, den)


def test_order_and_pivots():
    rng = np.random.default_rng(3)
    rare, often = rng.integers(0, 1 << 64, 4000, np.uint64), rng.integers(0, 1 << 64, 10, np.uint64)
    counts = np.array([100] * 5 + [700] * 5)
    order = ngram_join.Order(often, counts, 4000 + int(counts.sum()))
    s = np.unique(np.concatenate([rare[:50], often]))
    first = order.first(s, len(s))
    weight = {int(h): int(c) for h, c in zip(often, counts)}
    assert first.tolist() == sorted(s.tolist(), key=lambda h: (weight.get(h, 0), h))
    assert order.first(s, 7).tolist() == first[:7].tolist()
    place = dict(zip(s.tolist(), order.fragments(s).tolist()))
    assert [place[h] for h in first.tolist()] == sorted(place.values())  # fragments follow the order
    load = np.bincount(np.concatenate([order.fragments(np.sort(rare)), np.repeat(order.fragments(np.sort(often)), counts[np.argsort(often)])]), minlength=ngram_join.FRAGMENTS)
    assert load.sum() == 8000 and load.max() < 1.8 * load.mean()
    assert ngram_join.Order(often[:0], counts[:0], 0).fragments(s).max() < ngram_join.FRAGMENTS
