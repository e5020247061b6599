"""Ranking metrics against plain versions, the candidates, and the join strategies."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import learning, skew


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(2)
    score = np.round(rng.random(400), 2)
    label = (rng.random(400) < score).astype(int)
    return score, label, spark.createDataFrame([(float(s), int(y)) for s, y in zip(score, label)], "score double, label int")


def test_metrics(scored):
    score, label, frame = scored
    pairs = [(a > b) + 0.5 * (a == b) for a in score[label == 1] for b in score[label == 0]]
    assert learning.roc_auc(frame).first()[0] == pytest.approx(np.mean(pairs))
    ap, recall = 0.0, 0.0
    best = (-1, 0, 0)
    for t in sorted(set(score), reverse=True):
        called = score >= t
        p, r = label[called].mean(), label[called].sum() / label.sum()
        ap, recall = ap + (r - recall) * p, r
        best = max(best, (round(2 * p * r / (p + r), 12) if p + r else 0, p, t))
    assert learning.average_precision(frame).first()[0] == pytest.approx(ap)
    got = learning.best_threshold(frame).first()
    assert (got["threshold"], got["f1"]) == (best[2], pytest.approx(best[0]))
    m = learning.evaluate(frame, best[2])
    assert m["precision"] == pytest.approx(best[1]) and m["f1"] == pytest.approx(best[0])


def training(spark, n=900):
    rows = spark.range(n).withColumn("u", F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).withColumn("w", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0)
    values = {c: F.lit(None).cast("double") for c in learning.NUMBERS} | {"minutes_to_sla": F.col("u") * 100, "customer_breach_rate_90d": F.when(F.col("id") % 5 > 0, F.col("w"))}
    categories = {"priority": F.when(F.col("u") < 0.3, "P1").otherwise("P3"), "support_tier": F.lit(None).cast("string"), "customer_segment": F.lit("SMB")}
    split = F.element_at(F.array(*map(F.lit, learning.SPLITS)), (F.col("id") % 3 + 1).cast("int"))
    return rows.select(F.col("id").cast("string").alias("ticket_id"), F.current_timestamp().alias("as_of"), *[v.alias(c) for c, v in (values | categories).items()], ((F.col("u") + F.col("w") / 4) < 0.5).cast("int").alias("label"), split.alias("split"))


def test_training(spark, tmp_path):
    frame = training(spark).cache()
    got = learning.train(frame, str(tmp_path), ("logistic_regression",))
    assert got["chosen"] == "logistic_regression" and got["accepted"] and got["metrics"]["logistic_regression"]["test"]["roc_auc"] > 0.9
    assert (tmp_path / "manifest.json").is_file()
    with pytest.raises(ValueError):
        learning.check_cohorts(frame.withColumn("label", F.lit(1)))
    with pytest.raises(ValueError):
        learning.check_cohorts(frame.unionByName(frame.limit(1)))


def test_strategies_agree(spark):
    rows = skew.benchmark(spark, "r", 20_000, 50, 8, 4).collect()
    assert [r["strategy"] for r in rows] == list(skew.STRATEGIES) and {(r["joined_count"], r["event_id_sum"]) for r in rows} == {(20_000, 199_990_000)}
    plans = {r["strategy"]: r["plan"] for r in rows}
    assert "BroadcastHashJoin" in plans["broadcast"] and "SortMergeJoin" in plans["merge_baseline"] and "SortMergeJoin" in plans["salted_merge"]
    assert all(r["metrics_json"] != "{}" for r in rows)
    with pytest.raises(ValueError):
        skew.joined(*skew.skewed(spark, 10, 3), "other")
