"""Chronological training frame, ranking metrics in SQL, candidate models and the acceptance gate."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import at, exact_hour
from ..sources.store import Files
from .features import COLUMNS

SPLITS = ("train", "validation", "test")
CATEGORIES = ("priority", "support_tier", "customer_segment")
NUMBERS = tuple(c for c in COLUMNS if c not in CATEGORIES)
#: Acceptance: multiple of prevalence for PR-AUC, least ROC-AUC, least recall.
GATE = {"pr_auc": 1.2, "roc_auc": 0.60, "recall": 0.30}
#: Buckets of a score in which running sums are dealt out.
SCORE_BUCKETS = 64


def check_periods(label_as_of: datetime, train_end: datetime, validation_end: datetime, test_end: datetime) -> list[datetime]:
    """The four hours; they must rise, the last two may be equal."""
    ends = [exact_hour(x) for x in (train_end, validation_end, test_end)]
    label = exact_hour(label_as_of)
    if not (ends[0] < ends[1] < ends[2] <= label):
        raise ValueError("the ends of train, validation and test must rise and not pass the label's instant")
    return [label, *ends]


def training_frame(features: DataFrame, outcomes: DataFrame, label_as_of: datetime, train_end: datetime, validation_end: datetime, test_end: datetime) -> DataFrame:
    """Each ticket's first eligible snapshot with its label and split.

    Eligible: before the test's end, SLA not over yet, unlabelled. The ticket must have been resolved after the snapshot and by
    ``label_as_of``, have a deadline and no reopening; others are left out, not counted as negatives. On the deadline is in time.
    """
    label, train, validation, test = check_periods(label_as_of, train_end, validation_end, test_end)
    first = Window.partitionBy("ticket_id").orderBy("as_of")
    scored = features.where((F.col("as_of") < at(test)) & (F.col("minutes_to_sla") > 0) & F.col("sla_breached").isNull())
    scored = scored.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("as_of", "ticket_id", *COLUMNS)
    ended = outcomes.where((F.col("resolved_at") <= at(label)) & F.col("sla_deadline").isNotNull() & (F.col("reopen_count") == 0)).select("ticket_id", "resolved_at", "sla_deadline")
    split = F.when(F.col("as_of") < at(train), "train").when(F.col("as_of") < at(validation), "validation").otherwise("test")
    late = (F.col("resolved_at") > F.col("sla_deadline")).cast("int")
    both = scored.join(ended, "ticket_id").where(F.col("resolved_at") > F.col("as_of"))
    return both.select(at(label).alias("label_as_of"), "as_of", "ticket_id", *COLUMNS, "resolved_at", late.alias("label"), split.alias("split"))


def split_counts(frame: DataFrame) -> DataFrame:
    return frame.groupBy("split").agg(F.count("*").alias("rows"), F.sum("label").cast("bigint").alias("breaches"))


def cohorts(frame: DataFrame) -> DataFrame:
    """By split: rows, breaches, rows of an unknown split or label, rows of tickets that other rows have too, and whether the split can be used."""
    known = F.coalesce(F.col("label").isin(0, 1) & F.col("split").isin(*SPLITS), F.lit(False))
    # Rows of a ticket are counted map-side first, by split, so that a repeat in another split shows too.
    by_ticket = frame.groupBy("ticket_id", "split").agg(F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("breaches"), F.count_if(~known).alias("unknown"))
    again = by_ticket.groupBy("ticket_id").agg(F.sum("n").alias("all"))
    rows = by_ticket.join(again.withColumnRenamed("ticket_id", "_id"), F.col("ticket_id").eqNullSafe(F.col("_id")))
    out = rows.groupBy("split").agg(F.sum("n").alias("rows"), F.sum("breaches").alias("breaches"), F.sum("unknown").alias("unknown"), F.sum(F.when(F.col("all") > 1, F.col("n")).otherwise(0)).alias("repeated"))
    return out.withColumn("usable", (F.col("breaches") > 0) & (F.col("breaches") < F.col("rows")) & (F.col("unknown") == 0) & (F.col("repeated") == 0))


def check_cohorts(frame: DataFrame) -> dict[str, dict[str, int]]:
    """Rows and breaches by split. Unknown splits or labels, repeated tickets and splits of one class are refused."""
    found = {r["split"]: r for r in cohorts(frame).collect()}  # a row a split
    if any(r["unknown"] or r["repeated"] for r in found.values()):
        raise ValueError("the training data has unknown labels or splits, or a ticket twice")
    for split in SPLITS:
        if split not in found or not found[split]["usable"]:
            raise ValueError(f"{split} needs both classes")
    return {split: {"rows": r["rows"], "breaches": r["breaches"]} for split, r in found.items()}


def curve(scored: DataFrame) -> DataFrame:
    """For each distinct score (``score`` in 0..1, ``label`` 0 or 1): rows and positives at it and at it or above.

    Sums run inside buckets of about equally many scores, on top of the buckets' totals, so no task gets all scores however close they lie.
    """
    at_score = scored.groupBy("score").agg(F.count("*").alias("n"), F.sum("label").cast("bigint").alias("pos"))
    # One row with the cuts between the buckets.
    cuts = at_score.agg(F.percentile_approx("score", [i / SCORE_BUCKETS for i in range(1, SCORE_BUCKETS)], 10 * SCORE_BUCKETS).alias("_cuts"))
    at_score = at_score.crossJoin(F.broadcast(cuts)).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("score")))).drop("_cuts")
    above = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    totals = at_score.groupBy("_b").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    totals = totals.select("_b", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_n"), F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("_pos"))
    inside = Window.partitionBy("_b").orderBy(F.desc("score"))
    # At most SCORE_BUCKETS rows.
    both = at_score.join(F.broadcast(totals), "_b")
    return both.select("score", "n", "pos", (F.col("_n") + F.sum("n").over(inside)).alias("n_above"), (F.col("_pos") + F.sum("pos").over(inside)).alias("pos_above"))


def average_precision(scored: DataFrame) -> DataFrame:
    """Sum of precision times the step of recall over falling scores."""
    return curve(scored).agg((F.sum(F.col("pos") * F.col("pos_above") / F.col("n_above")) / F.sum("pos")).alias("average_precision"))


def roc_auc(scored: DataFrame) -> DataFrame:
    """Share of positive-negative pairs in the right order, ties half."""
    neg_above = F.col("n_above") - F.col("pos_above")
    neg = F.col("n") - F.col("pos")
    # A positive beats the negatives below its score.
    one = curve(scored).agg(F.sum("pos").alias("p"), F.sum(neg).alias("q"), F.sum(F.col("pos") * (neg_above - neg / 2.0)).alias("worse"))
    return one.select((1 - F.col("worse") / (F.col("p") * F.col("q"))).alias("roc_auc"))


def best_threshold(scored: DataFrame) -> DataFrame:
    """The score with the greatest F1 as threshold; ties go to precision, then to the score."""
    rows = curve(scored)
    total = rows.agg(F.sum("pos").alias("p"))
    rows = rows.crossJoin(F.broadcast(total))  # one row
    precision, recall = F.col("pos_above") / F.col("n_above"), F.col("pos_above") / F.col("p")
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    best = F.max(F.struct(F.round(f1, 12).alias("f1"), precision.alias("precision"), F.col("score").alias("threshold"), recall.alias("recall")))
    return rows.agg(best.alias("b")).select("b.threshold", "b.f1", "b.precision", "b.recall")


def evaluate(scored: DataFrame, threshold: float) -> dict[str, float]:
    """Precision, recall and F1 at a threshold, average precision and ROC-AUC."""
    hit = F.col("score") >= threshold
    row = scored.agg(F.count_if(hit & (F.col("label") == 1)).alias("tp"), F.count_if(hit).alias("called"), F.sum("label").alias("p")).first()
    precision = row["tp"] / row["called"] if row["called"] else 0.0
    recall = row["tp"] / row["p"] if row["p"] else 0.0
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return {"precision": precision, "recall": recall, "f1": f1, "pr_auc": average_precision(scored).first()[0], "roc_auc": roc_auc(scored).first()[0]}


def choose(results: dict[str, dict[str, dict[str, float]]]) -> str:
    """The candidate with the best validation PR-AUC, then recall, then precision; the first of equals."""
    best = None
    for name, by_split in results.items():
        rank = tuple(by_split["validation"][m] for m in ("pr_auc", "recall", "precision"))
        if best is None or rank > best[0]:
            best = rank, name
    return best[1]


def gate_failures(metrics: dict[str, float], prevalence: float) -> list[str]:
    """Why a model isn't good enough; none if it is."""
    checks = (
        (metrics["pr_auc"] < GATE["pr_auc"] * prevalence, "PR-AUC is below 1.2 times the prevalence"),
        (metrics["roc_auc"] < GATE["roc_auc"], "ROC-AUC is below 0.60"),
        (metrics["precision"] <= prevalence, "precision isn't above the prevalence"),
        (metrics["recall"] < GATE["recall"], "recall is below 0.30"),
    )
    return [text for failed, text in checks if failed]


def candidates(rows: int):
    """Spark ML pipelines by name; ``rows`` sets the logistic regression's penalty, 1 over all training rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    def pipeline(model):
        index = StringIndexer(inputCols=list(CATEGORIES), outputCols=[f"{c}_i" for c in CATEGORIES], handleInvalid="keep")
        hot = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"{c}_h" for c in CATEGORIES], dropLast=False)
        fill = Imputer(strategy="median", inputCols=list(NUMBERS), outputCols=[f"{c}_f" for c in NUMBERS])
        joined = VectorAssembler(inputCols=fill.getOutputCols(), outputCol="numbers")
        scale = StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True)
        return Pipeline(stages=[index, hot, fill, joined, scale, VectorAssembler(inputCols=["scaled", *hot.getOutputCols()], outputCol="features"), model])

    return {
        "logistic_regression": pipeline(LogisticRegression(maxIter=1000, regParam=1 / max(rows, 1), standardization=False)),
        "gradient_boosted_tree": pipeline(GBTClassifier(maxIter=100, maxDepth=4, stepSize=0.05, seed=42)),
    }


def prepared(frame: DataFrame) -> DataFrame:
    """Numbers as doubles, a column without any value as zeros, missing categories as ``unknown``."""
    some = frame.agg(*[F.count(c).alias(c) for c in NUMBERS]).first()
    numbers = [(F.col(c) if some[c] else F.lit(0)).cast("double").alias(c) for c in NUMBERS]
    return frame.select("ticket_id", "split", "label", *numbers, *[F.coalesce(c, F.lit("unknown")).alias(c) for c in CATEGORIES])


def train(frame: DataFrame, folder: str | None = None, names: tuple[str, ...] = ("logistic_regression", "gradient_boosted_tree"), version: int | None = None) -> dict:
    """Fit the candidates on train, pick by validation, and gate on test. Training stays on the executors.

    ``folder``, on any file system, gets the chosen pipeline as ``model`` and a JSON manifest, which names the training table's ``version`` to read it again.
    """
    from pyspark.ml.functions import vector_to_array

    cohort = check_cohorts(frame)
    rows = prepared(frame).cache()
    fingerprint = frame.agg(F.count("*").alias("rows"), F.sum(F.xxhash64("ticket_id", "as_of", "label").cast("decimal(38,0)")).cast("string").alias("hash")).first().asDict()
    part = {s: rows.where(F.col("split") == s) for s in SPLITS}
    results, thresholds, fitted = {}, {}, {}
    for name in names:
        model = fitted[name] = candidates(cohort["train"]["rows"])[name].fit(part["train"])
        scored = {s: model.transform(part[s]).select("label", vector_to_array("probability")[1].alias("score")).cache() for s in SPLITS[1:]}
        thresholds[name] = best_threshold(scored["validation"]).first()["threshold"]
        results[name] = {s: evaluate(scored[s], thresholds[name]) for s in scored}
        for s in scored.values():
            s.unpersist()
    rows.unpersist()
    chosen = choose(results)
    prevalence = cohort["test"]["breaches"] / cohort["test"]["rows"]
    failures = gate_failures(results[chosen]["test"], prevalence)
    out = {"cohorts": cohort, "data": fingerprint | {"version": version}, "metrics": results, "thresholds": thresholds, "chosen": chosen, "prevalence": prevalence, "failures": failures, "accepted": not failures}
    if folder:
        fitted[chosen].write().overwrite().save(f"{folder}/model")
        Files(frame.sparkSession).write(f"{folder}/manifest.json", json.dumps(out, indent=2, default=str), overwrite=True)
    return out
