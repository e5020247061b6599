"""Published snapshots with hand-computed cohorts."""

from datetime import datetime, timedelta

import pytest
from helpers import H, contract, frame

from tidewell.functions.expr import UTC
from tidewell.operators import features as features_of
from tidewell.operators import gold, learning, state

M, D = timedelta(minutes=1), timedelta(days=1)
TICK = timedelta(microseconds=1)


def states(spark, tickets, contracts, as_of, events=()):
    return state.ticket_state(frame(spark, "tickets", tickets), frame(spark, "ticket_events", list(events)), contract(spark, contracts), as_of)


def t(i, **v):
    return {"ticket_id": i, "customer_id": "c1", "product_id": "p1", "priority": "P1", "created_at": H, "final_status": "resolved"} | v


TERMS = [{"contract_id": "k1", "customer_id": "c1", "priority": "P1", "support_tier": "premium", "resolution_sla_minutes": 30}]


def test_operations(spark):
    rows = [t("a", closed_at=H + 30 * M), t("b", closed_at=H + 45 * M, escalated=True), t("c", closed_at=H + 60 * M), t("future", created_at=H + 60 * M, closed_at=H + 120 * M), t("unknown", customer_id="missing", final_status="open")]
    late = [{"event_id": "e", "ticket_id": "c", "event_type": "priority_changed", "new_value": "P2", "event_time": H + 120 * M}]
    accounts = frame(spark, "accounts", [{"customer_id": "c1", "segment": "enterprise"}])
    got = {r["support_tier"]: r for r in gold.operations(states(spark, rows, TERMS, H + 60 * M - TICK, late), accounts, H).collect()}
    assert set(got) == {"premium", "unknown"}
    p = got["premium"]
    assert (p["tickets_created"], p["tickets_resolved"], p["open_backlog"], p["p1_ticket_count"], p["p2_ticket_count"], p["median_resolution_minutes"], p["sla_breach_rate"], p["escalation_rate"], p["reopen_rate"]) == (3, 2, 1, 1, 0, 37.5, 0.5, pytest.approx(1 / 3), 0)
    assert got["unknown"]["customer_segment"] == "unknown" and got["unknown"]["sla_breach_rate"] is None and got["unknown"]["median_resolution_minutes"] is None
    after = [r for r in gold.operations(states(spark, rows, TERMS, H + 120 * M - TICK, late), accounts, H + 60 * M).collect() if r["support_tier"] == "premium"]
    assert [(r["tickets_created"], r["tickets_resolved"], r["open_backlog"]) for r in after] == [(1, 1, 1)]


def test_range_equals_hours(spark, sf):
    from tidewell.plans import domain as Dm

    tickets, contracts, accounts = Dm.tickets(spark, sf), Dm.contracts(spark, sf), Dm.accounts(spark, sf)
    first = datetime(1996, 6, 10, tzinfo=UTC)
    bulk = gold.operations_range(state.with_terms(tickets, contracts), accounts, first, 4)
    none = frame(spark, "ticket_events", [])
    for h in (0, 3):
        hour = first + timedelta(hours=h)
        one = gold.operations(state.ticket_state(tickets, none, contracts, hour + timedelta(hours=1) - TICK), accounts, hour)
        key = lambda r: tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in (r[c] for c in sorted(one.columns)))
        assert sorted(map(key, one.collect()), key=repr) == sorted(map(key, bulk.where(bulk["hour"] == hour).collect()), key=repr)


def test_health(spark):
    accounts = frame(spark, "accounts", [{"customer_id": c, "support_tier": s, "annual_contract_value": v} for c, s, v in (("c1", "platinum", 1200.0), ("c2", "standard", 300.0), ("c3", "standard", 500.0))])
    terms = TERMS + [{"contract_id": "k2", "customer_id": "c1", "priority": "P2", "support_tier": "premium", "resolution_sla_minutes": 60}]
    rows = [
        t("t1", created_at=H - 10 * D, closed_at=H - 9 * D, escalated=True), t("t2", priority="P2", created_at=H - 30 * D, closed_at=H - D), t("t3", created_at=H - 90 * D, closed_at=H - 90 * D + 30 * M),
        t("t4", created_at=H - 20 * D, final_status="open"), t("old", customer_id="c3", created_at=H - 91 * D, final_status="open"), t("future", created_at=H, final_status="open"),
    ]
    turns = [{"event_id": f"e{n}", "ticket_id": "t4", "event_type": k, "event_time": H - d * D} for n, (k, d) in enumerate((("ticket_resolved", 19), ("ticket_reopened", 18)))]
    got = {r["customer_id"]: r for r in gold.health(states(spark, rows, terms, H - TICK, turns), accounts, H).collect()}
    c1 = got["c1"]
    assert (c1["open_ticket_count"], c1["p1_ticket_count"], c1["ticket_count_30d"], c1["breach_rate_90d"], c1["escalation_rate_90d"], c1["reopen_rate_90d"], c1["average_resolution_minutes"], c1["support_tier"]) == (1, 1, 3, pytest.approx(2 / 3), 0.25, 0.25, 14410, "platinum")
    assert (got["c2"]["open_ticket_count"], got["c2"]["breach_rate_90d"]) == (0, None) and (got["c3"]["open_ticket_count"], got["c3"]["ticket_count_30d"], got["c3"]["escalation_rate_90d"]) == (1, 0, None)
    later = {r["customer_id"]: r for r in gold.health(states(spark, rows, terms, H + 60 * M - TICK, turns), accounts, H + 60 * M).collect()}["c1"]
    assert (later["open_ticket_count"], later["ticket_count_30d"], later["breach_rate_90d"]) == (2, 3, 1.0)


def test_incidents(spark):
    products = frame(spark, "products", [{"product_id": p} for p in ("p1", "p2", "p3")])
    rows = [t(f"b{d}", created_at=H - d * D + 5 * M) for d in (1, 2, 4, 5, 6, 7, 8)] + [t("hour", created_at=H - 3 * D - 60 * M)]
    rows += [t(f"n{i}", customer_id=f"c{i % 3}", priority="P1" if i < 2 else "P3", escalated=i == 0, final_status="open") for i in range(5)]
    rows += [t(f"q{i}", product_id="p2", customer_id=f"c{i}", final_status="open") for i in range(4)] + [t("next", created_at=H + 60 * M, final_status="open")]
    got = {r["product_id"]: r for r in gold.incidents(states(spark, rows, [], H + 60 * M - TICK), products, H).collect()}
    p1 = got["p1"]
    assert (p1["ticket_count"], p1["unique_customers"], p1["p1_count"], p1["escalation_count"], p1["ticket_volume_baseline"], p1["volume_deviation"], p1["incident_signal"]) == (5, 3, 2, 1, pytest.approx(6 / 7), pytest.approx(5 - 6 / 7), True)
    assert (got["p2"]["ticket_count"], got["p2"]["ticket_volume_baseline"], got["p2"]["incident_signal"]) == (4, 0, False) and (got["p3"]["ticket_count"], got["p3"]["incident_signal"]) == (0, False)


def test_features(spark):
    terms = [{"contract_id": "k", "customer_id": "c1", "priority": "P1", "support_tier": "Premium", "resolution_sla_minutes": 120}]
    rows = [t("active", created_at=H - 60 * M, final_status="open"), t("breached", created_at=H - 180 * M, closed_at=H - 30 * M, escalated=True), t("old", created_at=H - 31 * D, final_status="open"), t("future", created_at=H, final_status="open")]
    turns = [{"event_id": f"e{n}", "ticket_id": "active", "event_type": k, "event_time": H + m * M} for n, (k, m) in enumerate((("customer_replied", -40), ("agent_replied", -30), ("engineering_escalated", -20), ("customer_replied", 1)))]
    accounts = frame(spark, "accounts", [{"customer_id": "c1", "segment": "Enterprise"}])
    events = frame(spark, "ticket_events", turns)
    # A breach of 150 minutes against 120.
    got = {r["ticket_id"]: r for r in features_of.features(states(spark, rows, terms, H - TICK, turns), accounts, events, H).collect()}
    assert set(got) == {"active", "old"}
    a = got["active"]
    assert (a["ticket_age_minutes"], a["minutes_to_sla"], a["message_count"], a["customer_message_count"], a["agent_message_count"], a["previous_escalation_count"], a["customer_segment"]) == (59, 60, 2, 1, 1, 1, "Enterprise")
    assert (a["customer_ticket_count_30d"], a["customer_breach_rate_90d"], a["product_ticket_count_24h"], a["product_escalation_rate_24h"], a["product_breach_rate_7d"], a["sla_breached"]) == (1, 1.0, 1, 1.0, 1.0, None)


def test_backfill(spark):
    B = datetime(2025, 1, 1, 12, tzinfo=UTC)
    rows = [t("first", created_at=B - 120 * M, closed_at=B + 30 * M, escalated=True), t("second", created_at=B - 50 * M, closed_at=B + 60 * M), t("third", created_at=B + 20 * M, closed_at=B + 120 * M), t("fast", customer_id="c2", created_at=B + M, closed_at=B + 10 * M)]
    terms = [{"contract_id": c, "customer_id": c, "priority": "P1", "support_tier": "Premium", "resolution_sla_minutes": 120} for c in ("c1", "c2")]
    accounts = frame(spark, "accounts", [{"customer_id": "c1"}, {"customer_id": "c2"}])
    before = B + 3 * 60 * M
    got = {r["ticket_id"]: r for r in features_of.backfill(frame(spark, "tickets", rows), contract(spark, terms), accounts, before).collect()}
    assert set(got) == {"first", "second", "third"}
    assert (got["first"]["ticket_age_minutes"], got["first"]["minutes_to_sla"], got["first"]["previous_escalation_count"]) == (59, 60, 0)
    s, th = got["second"], got["third"]
    assert (s["customer_ticket_count_30d"], s["customer_breach_rate_90d"], s["customer_escalation_rate_90d"]) == (1, None, 0.0)
    assert (th["customer_ticket_count_30d"], th["customer_breach_rate_90d"], th["customer_escalation_rate_90d"], th["product_breach_rate_7d"]) == (2, 1.0, 0.5, 0.5)
    none = frame(spark, "ticket_events", [])
    features_of.check_backfill(none, None, before)
    with pytest.raises(ValueError):
        features_of.check_backfill(frame(spark, "ticket_events", [{"event_time": B}]), None, before)


def test_training(spark):
    E = datetime(2026, 1, 1, 5, tzinfo=UTC)
    hour = timedelta(hours=1)
    base = dict.fromkeys(features_of.COLUMNS)
    snaps = [("train", 0, 10), ("train", 1, 10), ("validation", 1, 10), ("test", 2, 10), ("censored", 0, 10), ("overdue", 0, -1), ("reopened", 0, 10), ("before", 1, 10)]
    numbers = {c: "string" if c in learning.CATEGORIES else "double" if "rate" in c else "bigint" for c in features_of.COLUMNS}
    ddl = "as_of timestamp, ticket_id string, " + ", ".join(f"{c} {k}" for c, k in numbers.items()) + ", sla_breached boolean"
    frame_ = spark.createDataFrame([(E + h * hour, i, *(left if c == "minutes_to_sla" else base[c] for c in numbers), None) for i, h, left in snaps], ddl)
    ends = [("train", 3, 2, 0), ("validation", 3, 4, 0), ("test", 4, 4, 0), ("overdue", 3, 2, 0), ("reopened", 3, 2, 1), ("before", 1, 2, 0), ("censored", 7, 2, 0)]
    outcomes = spark.createDataFrame([(i, E + r * hour, E + d * hour, n) for i, r, d, n in ends], "ticket_id string, resolved_at timestamp, sla_deadline timestamp, reopen_count int")
    got = {r["ticket_id"]: (r["split"], r["label"], r["as_of"].hour) for r in learning.training_frame(frame_, outcomes, E + 6 * hour, E + hour, E + 2 * hour, E + 3 * hour).collect()}
    assert {i: v[:2] for i, v in got.items()} == {"train": ("train", 1), "validation": ("validation", 0), "test": ("test", 0)}


def test_whole_backfill_takes_every_ticket(spark, sf):
    """No ticket is created after the first event, so all but those closed before their first whole hour get features."""
    from pyspark.sql import functions as F

    from tidewell.plans import domain as Dm
    from tidewell.plans import queries

    first = Dm.ticket_events(spark, sf).agg(F.date_trunc("hour", F.min("event_time"))).first()[0]
    tickets = Dm.tickets(spark, sf)
    assert first.replace(tzinfo=UTC) == queries.FIRST_EVENT and tickets.where(F.col("created_at") >= first).count() == 0
    late = tickets.where("closed_at is null or closed_at >= date_trunc('hour', created_at) + interval 1 hour")
    got = queries.op_features_backfill_whole(spark, sf)
    assert got.count() == late.count() == got.select("ticket_id").distinct().count() > 10_000


def test_all_hours(spark):
    """Hours from the first creation to the last close, each as the single-hour form has it; a long open ticket costs two events."""
    rows = [t("a", closed_at=H + 200 * M, escalated=True), t("b", priority="P2", created_at=H + 61 * M, closed_at=H + 65 * M, escalated=True), t("c", created_at=H + 90 * M, final_status="open"), t("d", customer_id="x", created_at=H + 130 * M, closed_at=H + 500 * M), t("e", created_at=H + 5 * M, closed_at=H + 600 * M, final_status="open")]
    accounts = frame(spark, "accounts", [{"customer_id": "c1", "segment": "enterprise"}])
    tickets = frame(spark, "tickets", rows)
    bulk = gold.operations_all(state.with_terms(tickets, contract(spark, TERMS)), accounts)
    got, names = bulk.collect(), sorted(bulk.columns)
    assert {(r["hour"].replace(tzinfo=UTC) - H) / (60 * M) for r in got} == set(range(11))
    for h in range(11):
        hour = H + h * 60 * M
        one = gold.operations(states(spark, rows, TERMS, hour + 60 * M - TICK), accounts, hour).collect()
        key = lambda r: repr(tuple(r[c] for c in names))
        assert sorted(map(key, one)) == sorted(key(r) for r in got if r["hour"].replace(tzinfo=UTC) == hour)
