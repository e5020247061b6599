"""Ticket features at an instant, and their backfill for tickets before the first event.

Peers of a ticket are the other tickets of its customer or product. Neither path joins
tickets with tickets: the snapshot takes each key's totals less the ticket's own share, the
backfill takes sums up to an instant over the instants of creation and closing.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import DAY, HOUR, MINUTE, at, exact_hour, floor_minutes, micros, us
from .state import active, with_contract

COLUMNS = (
    "ticket_age_minutes", "minutes_to_sla", "priority", "support_tier", "customer_segment", "message_count", "customer_message_count", "agent_message_count",
    "reopen_count", "priority_change_count", "previous_escalation_count", "customer_ticket_count_30d", "customer_breach_rate_90d",
    "customer_escalation_rate_90d", "product_ticket_count_24h", "product_escalation_rate_24h", "product_breach_rate_7d",
)


def _share(n: Column, own_n: Column, hit: Column, own_hit: Column) -> Column:
    """Rate among the others of a group."""
    return F.when(n - own_n > 0, (hit - own_hit).cast("double") / (n - own_n))


def peers(states: DataFrame, scored: DataFrame, key: str, as_of: datetime, count_back: timedelta, escalation_back: timedelta, breach_back: timedelta) -> DataFrame:
    """ticket_id, peers created in ``count_back``, and rates of breach and escalation among the scored tickets' peers, without a self-join."""
    created = F.col("created_at") >= at(as_of - count_back)
    escalation = F.col("created_at") >= at(as_of - escalation_back)
    resolved = F.coalesce((F.col("resolved_at") >= at(as_of - breach_back)) & F.col("sla_deadline").isNotNull(), F.lit(False))
    flags = {
        "c": created,
        "en": escalation,
        "e": escalation & (F.col("escalation_count") > 0),
        "bn": resolved,
        "b": resolved & (F.col("resolved_at") > F.col("sla_deadline")),
    }
    totals = states.groupBy(key).agg(*[F.count_if(f).alias(f"_{n}") for n, f in flags.items()])
    own = scored.select("ticket_id", key, *[F.coalesce(f, F.lit(False)).cast("bigint").alias(f"_own_{n}") for n, f in flags.items()])
    both = own.join(totals, key, "left")
    col = F.col
    return both.select(
        "ticket_id",
        F.coalesce(col("_c") - col("_own_c"), F.lit(0)).alias("peers"),
        _share(col("_bn"), col("_own_bn"), col("_b"), col("_own_b")).alias("breach_rate"),
        _share(col("_en"), col("_own_en"), col("_e"), col("_own_e")).alias("escalation_rate"),
    )


def event_counts(events: DataFrame, as_of: datetime) -> DataFrame:
    """Customer replies, agent replies and changes of priority before ``as_of``, applied or not, by ticket."""
    kinds = {"customer_message_count": "customer_replied", "agent_message_count": "agent_replied", "priority_change_count": "priority_changed"}
    return events.where(F.col("event_time") < at(as_of)).groupBy("ticket_id").agg(*[F.count_if(F.col("event_type") == k).alias(n) for n, k in kinds.items()])


def features(states: DataFrame, accounts: DataFrame, events: DataFrame, as_of: datetime) -> DataFrame:
    """Features of the tickets active at ``as_of``; ``states`` are those one microsecond before. The label is unknown yet."""
    as_of = exact_hour(as_of)
    now = states.where(active())
    days = lambda n: timedelta(days=n)
    customer = peers(states, now, "customer_id", as_of, days(30), days(90), days(90)).toDF("ticket_id", "customer_ticket_count_30d", "customer_breach_rate_90d", "customer_escalation_rate_90d")
    product = peers(states, now, "product_id", as_of, days(1), days(1), days(7)).toDF("ticket_id", "product_ticket_count_24h", "product_breach_rate_7d", "product_escalation_rate_24h")
    rows = now.join(accounts.select("customer_id", F.col("segment").alias("customer_segment")), "customer_id", "left")
    rows = rows.join(customer, "ticket_id", "left").join(product, "ticket_id", "left").join(event_counts(events, as_of), "ticket_id", "left")
    big = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    made = {"ticket_age_minutes": F.col("minutes_open"), "previous_escalation_count": big("escalation_count")}
    made |= {c: big(c) for c in ("message_count", "customer_message_count", "agent_message_count", "reopen_count", "priority_change_count")}
    return rows.select(at(as_of).alias("as_of"), "ticket_id", *[made.get(c, F.col(c)).alias(c) for c in COLUMNS], F.lit(None).cast("boolean").alias("sla_breached"))


def before(stream: DataFrame, asks: DataFrame, key: str, names: list[str]) -> DataFrame:
    """For each ask (key, t and what else it has): the sums of ``names`` over the stream's rows (key, t) of its key before ``t``.

    Sums run inside a key's days on top of its earlier days' totals, so that even a key with most rows is dealt over as many tasks as it has days.
    """
    own = [c for c in asks.columns if c not in (key, "t")]
    day = F.floor(F.col("t") / F.lit(DAY)).alias("_day")
    rows = stream.select(key, "t", day, *[F.col(n).cast("bigint").alias(n) for n in names], F.lit(None).cast(asks.select(F.struct(*own)).schema[0].dataType).alias("_ask"))
    rows = rows.unionByName(asks.select(key, "t", day, *[F.lit(0).cast("bigint").alias(n) for n in names], F.struct(*own).alias("_ask")))
    days = rows.groupBy(key, "_day").agg(*[F.sum(n).alias(f"_{n}") for n in names])
    earlier = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(key, "_day", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in names])
    inside = Window.partitionBy(key, "_day").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    found = rows.select(key, "_day", "_ask", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(n) for n in names]).where("_ask is not null")
    return found.join(days, [key, "_day"]).select("_ask.*", *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in names])


def _before(history: DataFrame, target: DataFrame, key: str, count_back: int, escalation_back: int, breach_back: int) -> DataFrame:
    """ticket_id, peers and their rates at each target's instant, from sums at that instant less sums at the windows' beginnings."""
    known = history.where(F.col(key).isNotNull())
    breach = F.col("closed_at") > F.col("sla_deadline")
    zero = {n: F.lit(0) for n in ("n", "e", "bn", "b", "gone")}
    event = lambda t, **sums: known.select(key, us(t).alias("t"), *[v.alias(n) for n, v in (zero | sums).items()]).where("t is not null")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("bigint")
    # An escalated ticket is closed and in the window from its close until its creation leaves the window.
    leaves = F.timestamp_micros(us("created_at") + F.lit(escalation_back))
    shows = flag(F.col("escalated") & (F.col("closed_at") < leaves))
    stream = event(F.col("created_at"), n=F.lit(1)).unionByName(event(F.greatest("closed_at", "created_at"), gone=F.when(F.col("closed_at").isNotNull(), shows).otherwise(0)))
    stream = stream.unionByName(event(F.col("closed_at"), bn=flag(breach.isNotNull()), b=flag(breach))).unionByName(event(leaves, gone=-shows))
    backs = {"": 0, "_count": count_back, "_escalation": escalation_back, "_breach": breach_back}
    asks = target.where(F.col(key).isNotNull()).select("ticket_id", key, F.explode(F.array(*[F.struct(F.lit(n).alias("at"), (us("as_of") - F.lit(b)).alias("t")) for n, b in backs.items()])).alias("a")).select("ticket_id", key, "a.*")
    sums = before(stream, asks, key, ["n", "bn", "b", "gone"])
    value = lambda n, when: F.max(F.when(F.col("at") == when, F.col(n)))
    found = sums.groupBy("ticket_id").agg(
        (value("n", "") - value("n", "_count")).alias("n"), (value("n", "") - value("n", "_escalation")).alias("en"), value("gone", "").alias("e"),
        *[(value(n, "") - value(n, "_breach")).alias(n) for n in ("bn", "b")],
    )
    # The ticket itself was created in every window and is open still.
    return found.select("ticket_id", (F.col("n") - 1).alias("peers"), F.when(F.col("bn") > 0, F.col("b") / F.col("bn")).alias("breach_rate"), F.when(F.col("en") > 1, F.col("e") / (F.col("en") - 1)).alias("escalation_rate"))


def backfill(tickets: DataFrame, contracts: DataFrame, accounts: DataFrame, until: datetime) -> DataFrame:
    """Features of tickets created before ``until``, each at the first whole hour after its creation, from what was visible then.

    For periods without events: a ticket counts as open by its close alone, and its escalation shows only once it is closed.
    """
    until = exact_hour(until)
    source = tickets.where(F.col("created_at") < at(until)).withColumn("as_of", F.timestamp_micros(us(F.date_trunc("hour", "created_at")) + F.lit(HOUR)))
    history = with_contract(source, contracts).withColumn("support_tier", F.col("contract.support_tier"))
    history = history.withColumn("sla_deadline", F.timestamp_micros(us("created_at") + F.col("contract.resolution_sla_minutes").cast("bigint") * F.lit(MINUTE))).drop("contract")
    target = history.where((F.col("as_of") < at(until)) & (F.col("closed_at").isNull() | (F.col("closed_at") >= F.col("as_of"))))
    customer = _before(history, target, "customer_id", 30 * DAY, 90 * DAY, 90 * DAY).toDF("ticket_id", "customer_ticket_count_30d", "customer_breach_rate_90d", "customer_escalation_rate_90d")
    product = _before(history, target, "product_id", DAY, DAY, 7 * DAY).toDF("ticket_id", "product_ticket_count_24h", "product_breach_rate_7d", "product_escalation_rate_24h")
    rows = target.join(accounts.select("customer_id", F.col("segment").alias("customer_segment")), "customer_id", "left").join(customer, "ticket_id", "left").join(product, "ticket_id", "left")
    last = us("as_of") - F.lit(1)
    made = {"ticket_age_minutes": floor_minutes(last - us("created_at")), "minutes_to_sla": floor_minutes(us("sla_deadline") - last)}
    made |= {c: F.lit(0).cast("bigint") for c in ("message_count", "customer_message_count", "agent_message_count", "reopen_count", "priority_change_count", "previous_escalation_count")}
    made |= {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("customer_ticket_count_30d", "product_ticket_count_24h")}
    return rows.select("as_of", "ticket_id", *[made.get(c, F.col(c)).alias(c) for c in COLUMNS], F.lit(None).cast("boolean").alias("sla_breached"))


def check_backfill(events: DataFrame, existing: DataFrame | None, before: datetime) -> None:
    """A backfill needs a period before the first event and without operational snapshots."""
    before = exact_hour(before)
    if not events.where(F.col("event_time") < at(before)).isEmpty():
        raise ValueError("there are ticket events before the end of the backfill")
    if existing is not None and not existing.where((F.col("as_of") < at(before)) & ~F.col("_pipeline_run_id").startswith("backfill_")).isEmpty():
        raise ValueError("the backfill overlaps operational snapshots")


def before_boundary(hour: datetime) -> datetime:
    """The instant whose state a snapshot at ``hour`` shows."""
    return exact_hour(hour) - timedelta(microseconds=1)


__all__ = ["COLUMNS", "backfill", "before", "before_boundary", "check_backfill", "event_counts", "features", "micros", "peers"]
