"""One query per operator family over the driver's tables. Instants leave as epoch microseconds, rates with six places."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import at, content_hash, us
from ..operators import features, gold, learning, quality, skew, state
from ..sources.store import Store, scratch_store
from ..streaming import landing
from . import domain as D
from . import silver

#: Instants of the queries.
HOUR = datetime(2024, 1, 15, 10, tzinfo=UTC)
AS_OF = datetime(2024, 1, 20, 12, tzinfo=UTC)
OLD_HOUR = datetime(1996, 6, 10, tzinfo=UTC)
HEALTH = datetime(1996, 7, 1, tzinfo=UTC)
BEFORE = datetime(1997, 1, 1, tzinfo=UTC)
FIRST_EVENT = datetime(2024, 1, 1, tzinfo=UTC)
TICK = timedelta(microseconds=1)
NOW = datetime(2024, 6, 1, tzinfo=UTC)
FOUND: dict = {}


def query(f):
    FOUND[f.__name__] = f
    return f


def plain(rows: DataFrame) -> DataFrame:
    """Instants as microseconds, dates as text, doubles rounded, counts as bigint."""
    form = {"timestamp": F.unix_micros, "double": lambda c: F.round(c, 6), "int": lambda c: c.cast("bigint"), "date": lambda c: c.cast("string")}
    return rows.select(*[form[t](F.col(c)).alias(c) if t in form else F.col(c) for c, t in rows.dtypes])


def _states(s: SparkSession, d: str, as_of: datetime) -> DataFrame:
    return state.ticket_state(D.tickets(s, d), D.ticket_events(s, d), D.contracts(s, d), as_of)


@query
def op_ticket_projection(s, d):
    start = state.projected(D.tickets(s, d), HEALTH).where("start is not null").select("ticket_id", "start.*")
    return plain(start.select("ticket_id", "customer_id", "status", "priority", F.col("created").alias("created_at"), F.col("updated").alias("last_updated_at"), F.col("resolved").alias("resolved_at"), F.col("escalations").alias("escalation_count")))


@query
def op_contract_pick(s, d):
    return plain(state.with_contract(D.tickets(s, d), D.contracts(s, d)).select("ticket_id", "contract.contract_id", "contract.support_tier", "contract.resolution_sla_minutes"))


@query
def op_sla_measures(s, d):
    return plain(_states(s, d, AS_OF).select("ticket_id", "contract_id", "support_tier", "sla_deadline", "minutes_to_sla", "minutes_open"))


@query
def op_state_fold(s, d):
    return plain(state.fold(D.tickets(s, d), D.ticket_events(s, d), AS_OF).where("applied_event_count + rejected_event_count > 0"))


@query
def op_state_summary(s, d):
    return plain(state.summary(_states(s, d, AS_OF)))


@query
def op_operations_hour(s, d):
    return plain(gold.operations(_states(s, d, HOUR + timedelta(hours=1) - TICK), D.accounts(s, d), HOUR))


@query
def op_operations_range(s, d):
    return plain(gold.operations_range(state.with_terms(D.tickets(s, d), D.contracts(s, d)), D.accounts(s, d), OLD_HOUR, 72))


@query
def op_operations_all_hours(s, d):
    """Totals over the groups of every hour from the first ticket's to the last close."""
    rows = gold.operations_all(state.with_terms(D.tickets(s, d), D.contracts(s, d)), D.accounts(s, d))
    return plain(rows.groupBy("hour").agg(*[F.sum(c).alias(c) for c in ("tickets_created", "tickets_resolved", "open_backlog", "p1_ticket_count", "p2_ticket_count")]))


@query
def op_health_snapshot(s, d):
    return plain(gold.health(_states(s, d, HEALTH - TICK), D.accounts(s, d), HEALTH))


@query
def op_incident_hour(s, d):
    return plain(gold.incidents(_states(s, d, HOUR + timedelta(hours=1) - TICK), D.products(s, d), HOUR))


@query
def op_incident_signals(s, d):
    made = D.table(s, d, "events").selectExpr("concat('PRD-', user_id % 7) as product_id", "user_id as customer_id", "concat('P', 1 + event_id % 4) as priority", "ts as created_at", "event_type = 'error' as escalated")
    return plain(gold.incidents_all(made))


@query
def op_event_type_counts(s, d):
    return plain(features.event_counts(D.ticket_events(s, d), AS_OF))


@query
def op_features_snapshot(s, d):
    # The features read the states several times.
    store = scratch_store(s)
    store.replace(_states(s, d, AS_OF - TICK), "silver", "ticket_state")
    return plain(features.features(store.read("silver", "ticket_state"), D.accounts(s, d), D.ticket_events(s, d), AS_OF).drop("sla_breached"))


@query
def op_features_backfill(s, d):
    return plain(features.backfill(D.tickets(s, d), D.contracts(s, d), D.accounts(s, d), BEFORE).drop("sla_breached"))


@query
def op_features_backfill_whole(s, d):
    """The backfill of all tickets before the hour of the first ticket event."""
    return plain(features.backfill(D.tickets(s, d), D.contracts(s, d), D.accounts(s, d), FIRST_EVENT).drop("sla_breached"))


def _peers(s, d, key, days):
    rows = _states(s, d, HEALTH - TICK)
    spans = [timedelta(days=n) for n in days]
    return plain(features.peers(rows, rows.where(state.active()), key, HEALTH, *spans))


@query
def op_peer_customer(s, d):
    return _peers(s, d, "customer_id", (30, 90, 90))


@query
def op_peer_product(s, d):
    return _peers(s, d, "product_id", (1, 1, 7))


def _classified(s, d, entity):
    raw = getattr(D, {"tickets": "raw_tickets", "ticket_events": "raw_events", "accounts": "raw_accounts", "contracts": "raw_contracts"}[entity])(s, d)
    known = D.tickets(s, d).where("cast(substring(ticket_id, 5) as bigint) % 10 = 0") if entity == "tickets" else None
    return quality.classify(raw, entity, NOW, D.accounts(s, d), D.products(s, d), known)


@query
def op_validate_tickets(s, d):
    return plain(_classified(s, d, "tickets").select("_record_hash", "disposition", "failure_reason", "record.ticket_id", "record.created_at", "record.priority", "record.final_status", "record.escalated"))


@query
def op_validate_events(s, d):
    return plain(_classified(s, d, "ticket_events").select("_record_hash", "disposition", "failure_reason", "record.event_type", "record.event_time", "record.new_value"))


@query
def op_validate_accounts(s, d):
    return plain(_classified(s, d, "accounts").select("_record_hash", "disposition", "failure_reason", "record.segment", "record.region", "record.annual_contract_value", "record.support_tier"))


@query
def op_validate_contracts(s, d):
    return plain(_classified(s, d, "contracts").select("_record_hash", "disposition", "failure_reason", "record.response_sla_minutes", "record.resolution_sla_minutes", "record.effective_from"))


@query
def op_quality_metrics(s, d):
    return plain(quality.metrics(_classified(s, d, "tickets")))


@query
def op_quarantine_reasons(s, d):
    rows = _classified(s, d, "tickets").where("disposition = 'quarantined'").select(F.explode("reasons").alias("reason"))
    return plain(rows.groupBy("reason").agg(F.count("*").alias("rows")))


@query
def op_first_candidate(s, d):
    rows = _classified(s, d, "tickets")
    return rows.where("disposition = 'accepted'").select("record.ticket_id", "_record_hash")


@query
def op_ref_exists(s, d):
    flagged = quality.with_references(D.raw_tickets(s, d), "tickets", D.accounts(s, d), D.products(s, d))
    return plain(flagged.groupBy(F.col("_customer_exists").alias("customer_exists"), F.col("_product_exists").alias("product_exists")).agg(F.count("*").alias("rows")))


@query
def op_content_hash(s, d):
    return D.table(s, d, "nation").select("n_nationkey", content_hash(["n_nationkey", "n_name", "n_regionkey"]).alias("record_hash"))


@query
def op_insert_only_merge(s, d):
    """All customers offered to a table that holds those in credit: rows held stay as they were."""
    store, people = scratch_store(s), D.table(s, d, "customer")
    store.append(people.where("c_acctbal >= 0").select("c_custkey", F.lit("held").alias("version")), "silver", "accounts")
    store.insert_only(people.select("c_custkey", F.lit("offered").alias("version")), "silver", "accounts", ["c_custkey"])
    return store.read("silver", "accounts")


@query
def op_update_only_merge(s, d):
    """Customers' numbers of orders, offered also for customers that the table doesn't have."""
    store = scratch_store(s)
    store.append(D.table(s, d, "customer").select("c_custkey", F.lit(-1).cast("bigint").alias("orders")), "silver", "accounts")
    counts = D.table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    store.update_only(counts.unionByName(counts.withColumn("c_custkey", -1 - F.col("c_custkey"))), "silver", "accounts", ["c_custkey"])
    return store.read("silver", "accounts")


@query
def op_replace_snapshot(s, d):
    """A snapshot of users' events for each type; clicks are published anew with other counts, views as an empty result."""
    store, rows = scratch_store(s), D.table(s, d, "events").select("event_type", "user_id", "event_id")
    part = lambda kind, n: rows.where(F.col("event_type") == kind).groupBy("event_type", "user_id").agg(n.alias("n"))
    for kind in ("signup", "click", "view", "error", "purchase"):
        store.replace_snapshot(part(kind, F.count("*")), "gold", "incident_signals", "event_type", kind)
    store.replace_snapshot(part("click", F.max("event_id")), "gold", "incident_signals", "event_type", "click")
    store.replace_snapshot(part("view", F.count("*")).limit(0), "gold", "incident_signals", "event_type", "view")
    return store.read("gold", "incident_signals")


@query
def op_replace_range(s, d):
    """Daily counts of a long backfill, then of a shorter one, beside an operational snapshot."""
    store, table = scratch_store(s), ("gold", "ticket_features")
    daily = lambda origin, n: D.table(s, d, "events").groupBy(F.date_trunc("day", "ts").alias("as_of")).agg(n.alias("n")).withColumn("origin", F.lit(origin))
    store.replace_snapshot(daily("live", F.count("*")).where(F.col("as_of") >= at(AS_OF)), *table, "as_of", AS_OF)
    store.replace_range(daily("first", F.count("*")).where(F.col("as_of") < at(AS_OF)), *table, "as_of", AS_OF, "backfill")
    store.replace_range(daily("second", F.max("event_id")).where(F.col("as_of") < at(HOUR)), *table, "as_of", HOUR, "backfill")
    return plain(store.read(*table))


@query
def op_time_travel(s, d):
    """A table read as of the version before its rows were replaced, and as it is."""
    store, table = scratch_store(s), ("ml", "training_dataset")
    nations = D.table(s, d, "nation").select("n_nationkey", "n_name")
    store.append(nations, *table)
    pinned = store.version(*table)
    store.replace(nations.withColumn("n_name", F.reverse("n_name")), *table)
    old, new = (store.read(*table, v).withColumn("version", F.lit(v).cast("bigint")) for v in (pinned, store.version(*table)))
    return old.unionByName(new)


@query
def op_validation_run(s, d):
    """A validation run over landed tickets, and what stands in the tables after it and a repeat of it."""
    store = scratch_store(s)
    for rows, layer, name in ((D.raw_tickets(s, d), "bronze", "tickets"), (D.accounts(s, d), "silver", "accounts"), (D.products(s, d), "silver", "products")):
        store.append(rows, layer, name)
    first, again = (silver.run(store, "tickets", "run/1", NOW) for _ in range(2))
    kept = store.read("silver", "tickets").agg(F.count("*").alias("silver_rows"), F.count_distinct("ticket_id").alias("silver_tickets"))
    bad = store.read("ops", "invalid_records").agg(F.count("*").alias("invalid_rows"))
    counts = ("records_read", "accepted_count", "duplicate_count", "quarantine_count")
    return kept.crossJoin(bad).select("*", *[F.lit(first[c]).cast("bigint").alias(c) for c in counts], F.lit(all(first[c] == again[c] for c in counts)).alias("repeat_is_equal"))


def _lines(s, d):
    """JSON lines of the events with broken ones among them."""
    body = F.to_json(F.struct(*D.ticket_events(s, d).columns), {"ignoreNullFields": "false"})
    rows = D.ticket_events(s, d).withColumn("k", F.expr("cast(substring(event_id, 5) as bigint)"))
    line = F.when(F.col("k") % 50 == 1, "not json").when(F.col("k") % 50 == 2, "{}}").when(F.col("k") % 50 == 3, "[1, 2, 3]").when(F.col("k") % 50 == 4, F.concat(body, F.lit(" junk"))).when(F.col("k") % 50 == 5, "  ").otherwise(body)
    return rows.select("k", line.alias("value"), F.concat(F.lit("file-"), F.expr("k div 1000").cast("string")).alias("_source_file"), "event_time")


@query
def op_stream_parse(s, d):
    rows = landing.parse(_lines(s, d).select("k", "value", "_source_file"))
    return rows.select("k", "event_id", "event_type", F.col("_corrupt_record").isNotNull().alias("malformed"), F.col("_corrupt_record").alias("corrupt"))


#: Batches of the landed stream.
BATCHES = 3


def _landed(s, d) -> Store:
    """The events landed as lines of three batches, every tenth twice and some again in the next batch; every batch once more, which must change nothing."""
    store, lines = scratch_store(s), _lines(s, d)
    top = D.table(s, d, "events").agg(F.max("event_id")).first()[0] + 1
    lines = lines.withColumn("b", F.expr(f"k * {BATCHES} div {top}"))
    again = lines.where("k % 10 = 0")
    lines = lines.unionByName(again).unionByName(again.where(f"b < {BATCHES - 1}").withColumn("b", F.col("b") + 1)).withColumn("_source_file", F.concat(F.lit("file-"), F.col("b").cast("string")))
    lines.select("b", "value", "_source_file").write.parquet(f"{store.root}/lines")
    lines = s.read.parquet(f"{store.root}/lines")
    for batch in (*range(BATCHES), *range(BATCHES)):
        landing.land_batch(store, lines.where(F.col("b") == batch).select("value", "_source_file"), batch, "events", "run", timedelta(hours=1))
    return store


@query
def op_late_label(s, d):
    """What landed: each content once, labelled late or not against the greatest time of the batches before, less an hour."""
    rows = _landed(s, d).read("bronze", "ticket_events").where(F.col(landing.CORRUPT).isNull())
    return rows.select("event_id", F.split_part("_pipeline_run_id", F.lit("/"), F.lit(2)).cast("bigint").alias("batch"), F.col("_is_late").alias("is_late"))


@query
def op_running_watermark(s, d):
    rows = D.table(s, d, "events").selectExpr("event_id div 500 as batch", "ts as event_time")
    return plain(landing.running_watermark(rows, "batch", timedelta(hours=1)))


@query
def op_batch_counters(s, d):
    rows = _landed(s, d).read("ops", "streaming_metrics")
    return plain(rows.select("batch_id", "rows_read", "rows_written", "duplicate_rows", "malformed_rows", "late_rows", "max_event_time", "watermark"))


@query
def op_dedup_by_hash(s, d):
    rows = D.table(s, d, "lineitem").select("l_returnflag", "l_linestatus").withColumn("_record_hash", content_hash(["l_returnflag", "l_linestatus"]))
    return rows.dropDuplicates(["_record_hash"]).select("l_returnflag", "l_linestatus")


PERIODS = (datetime(1998, 1, 1, tzinfo=UTC), datetime(1995, 9, 1, tzinfo=UTC), datetime(1996, 3, 1, tzinfo=UTC), BEFORE)


def _training(s, d):
    scored = features.backfill(D.tickets(s, d), D.contracts(s, d), D.accounts(s, d), BEFORE)
    return learning.training_frame(scored, _states(s, d, PERIODS[0]), *PERIODS)


@query
def op_training_frame(s, d):
    return plain(_training(s, d).select("as_of", "ticket_id", "ticket_age_minutes", "minutes_to_sla", "customer_ticket_count_30d", "product_breach_rate_7d", "resolved_at", "label", "split"))


@query
def op_split_counts(s, d):
    return plain(learning.split_counts(_training(s, d)))


@query
def op_cohort_check(s, d):
    return plain(learning.cohorts(_training(s, d)))


@query
def op_average_precision(s, d):
    return plain(learning.average_precision(D.scored(s, d)))


@query
def op_roc_auc(s, d):
    return plain(learning.roc_auc(D.scored(s, d)))


@query
def op_best_f1_threshold(s, d):
    return plain(learning.best_threshold(D.scored(s, d)))


def _join(strategy):
    def run(s, d):
        orders = D.table(s, d, "orders").selectExpr("o_orderkey as event_id", "if(o_orderkey % 2 = 0, 'customer_001', concat('customer_', o_custkey)) as customer_id")
        people = D.table(s, d, "customer").selectExpr("if(c_custkey = 0, 'customer_001', concat('customer_', c_custkey)) as customer_id", "c_mktsegment as support_tier").where("customer_id <> 'customer_1'")
        return skew.totals(skew.joined(orders, people, strategy, 16))

    return run


for _name, _strategy in (("default", "adaptive_default"), ("merge", "merge_baseline"), ("broadcast", "broadcast"), ("salted", "salted_merge")):
    FOUND[f"op_join_{_name}"] = _join(_strategy)


def _skewed(s, d):
    """Generated events and accounts, as many as there are orders and customers."""
    return skew.skewed(s, D.table(s, d, "orders").count(), D.table(s, d, "customer").count())


@query
def op_skewed_range(s, d):
    return skew.totals(skew.joined(*_skewed(s, d), "salted_merge", 8))


@query
def op_partition_skew(s, d):
    """Rows of each hash partition; which key falls where is Spark's, so there is no SQL for it."""
    return skew.partition_sizes(_skewed(s, d)[0], 64)


@query
def op_open_queue(s, d):
    """The ten open tickets nearest to or furthest past their deadline."""
    rows = _states(s, d, AS_OF).where(state.active()).where("minutes_to_sla is not null")
    return plain(rows.orderBy("minutes_to_sla", "ticket_id").select("ticket_id", "priority", "minutes_to_sla").limit(10))


def queries() -> dict:
    return dict(FOUND)


__all__ = ["at", "queries", "us"]
