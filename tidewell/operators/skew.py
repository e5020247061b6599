"""Join strategies over a skewed key, and how skewed it is."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STRATEGIES = ("merge_baseline", "adaptive_default", "broadcast", "salted_merge")
#: Customers with 35 and 15 of every 100 events.
HOT = ("customer_001", "customer_002")


def check_size(events: int, customers: int, partitions: int = 2, salts: int = 2) -> None:
    if events < 1 or customers < 3:
        raise ValueError("there must be an event and three customers at least")
    if partitions < 2 or salts < 2:
        raise ValueError("there must be two partitions and two salts at least")


def skewed(spark: SparkSession, events: int, customers: int) -> tuple[DataFrame, DataFrame]:
    """Events (event_id, customer_id), half of them of two customers, and accounts (customer_id, support_tier)."""
    check_size(events, customers)
    rest = F.expr(f"3 + (id div 100) % {customers - 2}")
    number = F.when(F.col("id") % 100 < 35, F.lit(1)).when(F.col("id") % 100 < 50, F.lit(2)).otherwise(rest)
    name = lambda c: F.format_string("customer_%03d", c.cast("bigint"))
    tier = F.element_at(F.array(F.lit("Premium"), F.lit("Standard"), F.lit("Enhanced")), (F.col("id") % 3 + 1).cast("int"))
    accounts = spark.range(1, customers + 1).select(name(F.col("id")).alias("customer_id"), tier.alias("support_tier"))
    return spark.range(events).select(F.col("id").alias("event_id"), name(number).alias("customer_id")), accounts


def joined(events: DataFrame, accounts: DataFrame, strategy: str, salts: int = 16, key: str = "customer_id", hot: tuple[str, ...] = HOT) -> DataFrame:
    """The inner join by one of the strategies. Salting deals a hot key's events over ``salts`` and repeats its account for each."""
    if strategy == "broadcast":
        return events.join(F.broadcast(accounts), key)
    if strategy == "merge_baseline":
        return events.join(accounts.hint("merge"), key)
    if strategy == "adaptive_default":
        return events.join(accounts, key)
    if strategy != "salted_merge":
        raise ValueError(f"unknown strategy {strategy}")
    is_hot = F.col(key).isin(*hot)
    dealt = events.withColumn("salt", F.when(is_hot, F.pmod("event_id", F.lit(salts))).otherwise(0).cast("int"))
    copies = accounts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(is_hot, salts - 1).otherwise(0))))
    return dealt.join(copies.hint("merge"), [key, "salt"])


def partition_sizes(events: DataFrame, partitions: int, key: str = "customer_id") -> DataFrame:
    """Rows in each partition when dealt by the key's hash."""
    return events.repartition(partitions, key).groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("rows"))


def totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("support_tier").agg(F.count("*").alias("joined_count"), F.sum("event_id").cast("bigint").alias("event_id_sum"))


def plan_metrics(df: DataFrame) -> dict[str, int]:
    """SQL counters of an executed frame's final plan, through adaptive stages."""
    out: dict[str, int] = {}

    def visit(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return visit(node.plan())
        pairs = node.metrics().iterator()
        while pairs.hasNext():
            pair = pairs.next()
            if value := pair._2().value():
                name = f"{node.nodeName()}.{pair._1()}"
                out[name] = out.get(name, 0) + value
        children = node.children().iterator()
        while children.hasNext():
            visit(children.next())

    visit(df._jdf.queryExecution().executedPlan())
    return out


def benchmark(spark: SparkSession, run_id: str, events: int = 1_000_000, customers: int = 1_000, partitions: int = 64, salts: int = 16) -> DataFrame:
    """One row per strategy with time, result checksum, plan and counters; the results must agree."""
    check_size(events, customers, partitions, salts)
    left, right = skewed(spark, events, customers)
    counts = sorted((r["rows"] for r in partition_sizes(left, partitions).collect()), reverse=True)
    out, seen = [], set()
    for strategy in STRATEGIES:
        began = time.perf_counter()
        result = totals(joined(left, right, strategy, salts))
        rows = sorted(map(tuple, result.collect()))
        took = time.perf_counter() - began
        seen.add(tuple(rows))
        out.append((run_id, strategy, events, customers, partitions, salts, took, sum(r[1] for r in rows), sum(r[2] for r in rows), json.dumps(counts), result._jdf.queryExecution().toString(), json.dumps(plan_metrics(result))))
    if len(seen) > 1:
        raise RuntimeError("the strategies' results differ")
    ddl = "run_id string, strategy string, event_count bigint, customer_count bigint, shuffle_partitions int, salt_buckets int, elapsed_seconds double, joined_count bigint, event_id_sum bigint, partition_counts_json string, plan string, metrics_json string"
    return spark.createDataFrame(out, ddl).withColumn("captured_at", F.current_timestamp())
