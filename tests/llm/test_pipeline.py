"""The pipeline's stages against plain versions on the small tables."""

import re
from collections import defaultdict

import public_tokenizers
import sentencepiece

import corpus_pipeline
from tidewell.llm.common import read


def _groups(rows):
    """Least doc_id by five-word shingle sets linked at 0.8."""
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    lists, parent = defaultdict(list), {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d in sorted(sets):
        shared = defaultdict(int)
        for g in sets[d]:
            for e in lists[g]:
                shared[e] += 1
            lists[g].append(d)
        for e, n in shared.items():
            if 5 * n >= 4 * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                parent[b] = a
    return {d: find(d) for d in sets}


def test_stages_take_effect(spark, sf):
    stages = dict(corpus_pipeline.STAGES)
    docs = read(spark, sf, "documents")
    labels = {r["doc_id"]: r["quality"] for r in read(spark, sf, "labels").collect()}

    kept = stages["quality_classifier"](spark, docs, sf).cache()
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    good, bad = [d for d in labels if labels[d] == 1], [d for d in labels if labels[d] == 0]
    assert sum(d in ids for d in good) >= 0.98 * len(good) and sum(d in ids for d in bad) <= 0.2 * len(bad)

    unique = stages["ngram_jaccard_join"](spark, kept, sf).cache()
    groups = _groups(map(tuple, kept.select("doc_id", "text").collect()))
    assert sorted(r["doc_id"] for r in unique.select("doc_id").collect()) == sorted(set(groups.values()))

    clean = stages["benchmark_decontamination"](spark, unique, sf).cache()
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(w[i : i + 10]) for (t,) in read(spark, sf, "benchmark").select("text").collect() for w in [words(t)] for i in range(max(1, len(w) - 9))}
    leaky = {d for d, t in unique.select("doc_id", "text").collect() for w in [words(t)] if any(tuple(w[i : i + 10]) in windows for i in range(len(w)))}
    assert {r["doc_id"] for r in clean.select("doc_id").collect()} == {r["doc_id"] for r in unique.select("doc_id").collect()} - leaky

    safe = stages["secret_scans"](spark, clean, sf).cache()
    assert safe.count() == clean.count() and safe.columns == docs.columns

    last = {r["doc_id"]: r for r in stages["sentencepiece"](spark, safe, sf).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for doc, text in safe.select("doc_id", "text").collect():
        assert last[doc]["ids"] == library.encode(text or "") and last[doc]["restored"]


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 500
