"""Ticket state at an instant: a historical row and its events folded in order, and SLA terms of the contract in force.

The fold is one ``aggregate`` over a ticket's sorted events; the contract is picked inside the row from
the few versions a customer has for a priority. No Python runs on the executors.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import MINUTE, at, floor_minutes, micros, us
from ..schema import ACTIVE, ENUMS

_STATE = (
    "struct<customer_id:string,product_id:string,status:string,priority:string,agent:string,created:bigint,updated:bigint,resolved:bigint,"
    "messages:int,reopens:int,escalations:int,applied:int,rejected:int>"
)
_ACTIVE = ", ".join(f"'{s}'" for s in ACTIVE)
_PRIORITIES = ", ".join(f"'{p}'" for p in ENUMS["priority"])
_AGENT = "coalesce(nullif(e.agent, ''), nullif(e.value, ''))"
# What makes an event apply to a ticket that exists.
_FITS = f"""case
    when e.kind = 'ticket_created' or e.at < s.created then false
    when e.kind in ('customer_replied', 'agent_replied') then true
    when e.kind in ('priority_changed', 'engineering_escalated', 'ticket_resolved') then s.status in ({_ACTIVE})
    when e.kind = 'agent_assigned' then s.status in ({_ACTIVE}) and {_AGENT} is not null
    when e.kind = 'status_changed' then coalesce(s.status in ({_ACTIVE}) and e.value in ({_ACTIVE}) or s.status = 'resolved' and e.value = 'closed', false)
    when e.kind = 'ticket_reopened' then s.status not in ({_ACTIVE})
    else false end"""
# The state after an event that applies; f is the event's kind.
_AFTER = f"""named_struct(
    'customer_id', s.customer_id, 'product_id', s.product_id,
    'status', case e.kind when 'status_changed' then e.value when 'ticket_resolved' then 'resolved' when 'ticket_reopened' then 'open'
        when 'customer_replied' then if(s.status = 'pending_customer', 'open', s.status) else s.status end,
    'priority', if(e.kind = 'priority_changed', e.value, s.priority),
    'agent', if(e.kind = 'agent_assigned', {_AGENT}, s.agent),
    'created', s.created, 'updated', greatest(s.updated, e.at),
    'resolved', case e.kind when 'ticket_resolved' then e.at when 'ticket_reopened' then cast(null as bigint) else s.resolved end,
    'messages', s.messages + int(e.kind in ('customer_replied', 'agent_replied')),
    'reopens', s.reopens + int(e.kind = 'ticket_reopened'),
    'escalations', s.escalations + int(e.kind = 'engineering_escalated'),
    'applied', s.applied + 1, 'rejected', s.rejected)"""
_BORN = f"""if(e.kind = 'ticket_created' and e.value in ({_PRIORITIES}) and e.customer_id is not null and e.product_id is not null,
    named_struct('customer_id', e.customer_id, 'product_id', e.product_id, 'status', 'open', 'priority', e.value, 'agent', e.agent,
        'created', e.at, 'updated', e.at, 'resolved', cast(null as bigint), 'messages', 0, 'reopens', 0, 'escalations', 0, 'applied', 1, 'rejected', 0),
    cast(null as {_STATE}))"""
_REJECTED = """named_struct('customer_id', s.customer_id, 'product_id', s.product_id, 'status', s.status, 'priority', s.priority, 'agent', s.agent,
    'created', s.created, 'updated', s.updated, 'resolved', s.resolved, 'messages', s.messages, 'reopens', s.reopens, 'escalations', s.escalations,
    'applied', s.applied, 'rejected', s.rejected + 1)"""
_FOLD = f"aggregate(events, start, (s, e) -> case when s is null then {_BORN} when {_FITS} then {_AFTER} else {_REJECTED} end)"


def projected(tickets: DataFrame, as_of: datetime) -> DataFrame:
    """Historical rows that exist at ``as_of``: ticket_id and ``start``, the state their row shows.

    A row is a snapshot at its close, or at its creation while open; before its close a resolved ticket counts as open.
    """
    limit = micros(as_of)
    closed = F.when(us("closed_at") <= limit, us("closed_at"))
    active = F.col("final_status").isin(*ACTIVE)
    state = F.struct(
        "customer_id",
        "product_id",
        F.when(active | closed.isNotNull(), F.col("final_status")).otherwise("open").alias("status"),
        "priority",
        F.col("agent_id").alias("agent"),
        us("created_at").alias("created"),
        F.coalesce(closed, us("created_at")).alias("updated"),
        closed.alias("resolved"),
        F.lit(0).alias("messages"),
        F.lit(0).alias("reopens"),
        (F.coalesce("escalated", F.lit(False)) & (F.col("closed_at").isNull() | closed.isNotNull())).cast("int").alias("escalations"),
        F.lit(0).alias("applied"),
        F.lit(0).alias("rejected"),
    )
    return tickets.select("ticket_id", F.when(us("created_at") <= limit, state.cast(_STATE)).alias("start"))


def histories(events: DataFrame, as_of: datetime) -> DataFrame:
    """Each ticket's events up to ``as_of``, in order of time and id, repeated ids once (the earliest)."""
    seen = Window.partitionBy("ticket_id", "event_id").orderBy("event_time")
    kept = events.where(F.col("event_time") <= at(as_of)).select("event_id", "ticket_id", "event_type", "event_time", "agent_id", "new_value", "customer_id", "product_id")
    # One exchange by ticket serves the window and the grouping.
    kept = kept.repartition("ticket_id").withColumn("_n", F.row_number().over(seen)).where("_n = 1")
    entry = F.struct(us("event_time").alias("at"), F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("agent_id").alias("agent"), F.col("new_value").alias("value"), "customer_id", "product_id")
    return kept.groupBy("ticket_id").agg(F.array_sort(F.collect_list(entry)).alias("events"))


def fold(tickets: DataFrame, events: DataFrame, as_of: datetime) -> DataFrame:
    """One row per ticket that exists at ``as_of``: its state columns, age and instant.

    Events at or before a historical row's snapshot are part of it and are skipped; a ticket created later has no row.
    """
    both = projected(tickets, as_of).withColumn("known", F.lit(True)).join(histories(events, as_of), "ticket_id", "full_outer")
    later = F.expr("filter(coalesce(events, array()), e -> start is null or e.at > start.updated)")
    state = both.where("known is null or start is not null").withColumn("events", later).withColumn("s", F.expr(_FOLD)).where("s is not null")
    end = F.coalesce(F.col("s.resolved"), F.lit(micros(as_of)))
    return state.select(
        "ticket_id",
        "s.customer_id",
        "s.product_id",
        "s.status",
        "s.priority",
        F.col("s.agent").alias("assigned_agent"),
        F.timestamp_micros("s.created").alias("created_at"),
        F.timestamp_micros("s.updated").alias("last_updated_at"),
        F.timestamp_micros("s.resolved").alias("resolved_at"),
        F.col("s.messages").alias("message_count"),
        F.col("s.reopens").alias("reopen_count"),
        F.col("s.escalations").alias("escalation_count"),
        F.col("s.applied").alias("applied_event_count"),
        F.col("s.rejected").alias("rejected_event_count"),
        F.greatest(F.lit(0).cast("bigint"), floor_minutes(end - F.col("s.created"))).alias("minutes_open"),
        at(as_of).alias("state_as_of"),
    )


def with_contract(rows: DataFrame, contracts: DataFrame, moment: str = "created_at") -> DataFrame:
    """``rows`` with ``contract``: of the customer's contracts for the row's priority that hold on the moment's UTC day (both
    ends included) the one that began last, of those the greatest contract_id; null if none holds."""
    version = F.struct("effective_from", "contract_id", "effective_to", "support_tier", "resolution_sla_minutes")
    terms = contracts.where("customer_id is not null and priority is not null").groupBy("customer_id", "priority").agg(F.collect_list(version).alias("_terms"))
    holds = f"filter(_terms, c -> c.effective_from <= to_date({moment}) and (c.effective_to is null or to_date({moment}) <= c.effective_to))"
    return rows.join(terms, ["customer_id", "priority"], "left").withColumn("contract", F.array_max(F.expr(holds))).drop("_terms")


def with_sla(states: DataFrame, contracts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """States with contract_id, support_tier, resolution_sla_minutes, sla_deadline and minutes_to_sla (null without a contract).

    The clock starts at creation and isn't restarted by a change of priority.
    """
    now = us("state_as_of") if as_of is None else F.lit(micros(as_of))
    due = us("created_at") + F.col("contract.resolution_sla_minutes").cast("bigint") * F.lit(MINUTE)
    found = with_contract(states, contracts)
    return found.select(
        *states.columns,
        "contract.contract_id",
        "contract.support_tier",
        "contract.resolution_sla_minutes",
        F.timestamp_micros(due).alias("sla_deadline"),
        floor_minutes(due - F.coalesce(us("resolved_at"), now)).alias("minutes_to_sla"),
    )


def ticket_state(tickets: DataFrame, events: DataFrame, contracts: DataFrame, as_of: datetime) -> DataFrame:
    """Point-in-time ticket states with their SLA measures."""
    return with_sla(fold(tickets, events, as_of), contracts)


def summary(states: DataFrame) -> DataFrame:
    """Tickets, applied and rejected events, overdue tickets and tickets without SLA."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return states.agg(
        F.count("*").alias("tickets"),
        total("applied_event_count").alias("applied_events"),
        total("rejected_event_count").alias("rejected_events"),
        F.count_if(F.col("minutes_to_sla") < 0).alias("breaches"),
        F.count_if(F.col("sla_deadline").isNull()).alias("without_sla"),
    )


def active(states: DataFrame | None = None) -> Column:
    return F.col("status").isin(*ACTIVE)


def with_terms(tickets: DataFrame, contracts: DataFrame) -> DataFrame:
    """Tickets with the tier and deadline of the contract in force at their creation (null without one)."""
    found = with_contract(tickets, contracts)
    due = us("created_at") + F.col("contract.resolution_sla_minutes").cast("bigint") * F.lit(MINUTE)
    return found.select(*tickets.columns, "contract.support_tier", F.timestamp_micros(due).alias("sla_deadline"))
