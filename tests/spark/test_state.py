"""The fold and the SLA terms: hand-computed cases and random histories against a plain fold."""

from datetime import date, timedelta

import numpy as np
import pytest
from helpers import H, contract, frame
from pyspark.sql import functions as F

from tidewell.operators import state
from tidewell.schema import ACTIVE

M = timedelta(minutes=1)


def ticket(**values):
    return {"ticket_id": "t", "customer_id": "c", "product_id": "p", "created_at": H, "priority": "P3", "final_status": "open"} | values


def event(n, kind, after, **values):
    return {"event_id": f"e{n:02d}", "ticket_id": "t", "customer_id": "c", "product_id": "p", "event_type": kind, "event_time": H + after * M} | values


def at(spark, tickets, events, as_of):
    return state.fold(frame(spark, "tickets", tickets), frame(spark, "ticket_events", events), as_of)


def test_sequence(spark):
    course = [
        event(1, "agent_assigned", 1, agent_id="a1"), event(2, "priority_changed", 2, new_value="P1"), event(3, "status_changed", 3, new_value="pending_customer"), event(4, "customer_replied", 4), event(5, "agent_replied", 5),
        event(6, "engineering_escalated", 6), event(7, "ticket_resolved", 7), event(8, "ticket_reopened", 8), event(9, "ticket_resolved", 9), event(10, "status_changed", 10, new_value="closed"),
    ]
    row = at(spark, [ticket()], course[::-1] + course[:1], H + 60 * M).first()
    assert (row["status"], row["priority"], row["assigned_agent"], row["message_count"], row["reopen_count"], row["escalation_count"], row["applied_event_count"], row["rejected_event_count"], row["minutes_open"]) == ("closed", "P1", "a1", 2, 1, 1, 10, 0, 9)
    early = at(spark, [ticket()], course, H + 7 * M).first()
    assert (early["status"], early["applied_event_count"], early["reopen_count"]) == ("resolved", 7, 0)
    assert at(spark, [ticket()], course, H - M).count() == 0


@pytest.mark.parametrize("bad", [
    event(1, "ticket_created", 1, new_value="P1"), event(1, "agent_assigned", 1), event(1, "agent_assigned", 1, agent_id="", new_value=""), event(1, "status_changed", 1, new_value="resolved"), event(1, "status_changed", 1, new_value="closed"),
    event(1, "status_changed", 1), event(1, "ticket_reopened", 1), event(1, "unknown", 1),
])
def test_rejected(spark, bad):
    row = at(spark, [ticket()], [bad], H + 60 * M).first()
    assert (row["rejected_event_count"], row["applied_event_count"], row["status"]) == (1, 0, "open")


def test_snapshot_and_birth(spark):
    closed = ticket(final_status="resolved", closed_at=H + 30 * M, escalated=True)
    row = at(spark, [closed], [event(1, "customer_replied", 30), event(2, "ticket_reopened", 31)], H + 60 * M).first()
    assert (row["status"], row["applied_event_count"], row["message_count"], row["escalation_count"], row["reopen_count"]) == ("open", 1, 0, 1, 1)
    before = at(spark, [closed], [], H + 29 * M).first()
    assert (before["status"], before["resolved_at"], before["escalation_count"]) == ("open", None, 0)
    born = at(spark, [], [event(1, "customer_replied", 0), event(2, "ticket_created", 1, new_value="P2", agent_id="x"), event(3, "ticket_resolved", 1)], H + 60 * M).first()
    assert (born["status"], born["priority"], born["assigned_agent"], born["applied_event_count"], born["rejected_event_count"]) == ("resolved", "P2", "x", 2, 0)
    assert at(spark, [], [event(1, "ticket_created", 1, new_value="urgent"), event(2, "agent_replied", 2)], H + 60 * M).count() == 0
    assert at(spark, [ticket(created_at=H + 90 * M)], [event(1, "ticket_created", 1, new_value="P2")], H + 60 * M).count() == 0


def plain_fold(start, events):
    s = dict(start) if start else None
    for e in events:
        kind, value = e["event_type"], e.get("new_value")
        if s is None:
            if kind == "ticket_created" and value in ("P1", "P2", "P3", "P4"):
                s = {"status": "open", "priority": value, "agent": e.get("agent_id"), "made": e["event_time"], "done": None, "m": 0, "r": 0, "x": 0, "ok": 1, "bad": 0}
            continue
        live, fits = s["status"] in ACTIVE, True
        if kind == "ticket_created" or e["event_time"] < s["made"]:
            fits = False
        elif kind in ("customer_replied", "agent_replied"):
            s["m"] += 1
            if kind == "customer_replied" and s["status"] == "pending_customer":
                s["status"] = "open"
        elif kind == "ticket_reopened" and not live:
            s |= {"status": "open", "done": None, "r": s["r"] + 1}
        elif kind == "status_changed" and (live and value in ACTIVE or s["status"] == "resolved" and value == "closed"):
            s["status"] = value
        elif live and kind == "agent_assigned" and (e.get("agent_id") or value):
            s["agent"] = e.get("agent_id") or value
        elif live and kind == "priority_changed":
            s["priority"] = value
        elif live and kind == "engineering_escalated":
            s["x"] += 1
        elif live and kind == "ticket_resolved":
            s |= {"status": "resolved", "done": e["event_time"]}
        else:
            fits = False
        s["ok" if fits else "bad"] += 1
    return s


def test_random_histories(spark):
    rng = np.random.default_rng(5)
    kinds = ["ticket_created", "agent_assigned", "priority_changed", "status_changed", "customer_replied", "agent_replied", "engineering_escalated", "ticket_resolved", "ticket_reopened"]
    values = {"ticket_created": ["P1", "P4", "zz"], "priority_changed": ["P1", "P2"], "status_changed": ["open", "in_progress", "pending_customer", "closed", "resolved", None]}
    events, want = [], {}
    for t in range(120):
        mine = []
        for n in range(int(rng.integers(1, 25))):
            kind = kinds[rng.integers(0, 9)]
            mine.append(event(n, kind, int(rng.integers(0, 12)), ticket_id=f"t{t}", event_id=f"e{t:03d}-{n:02d}", new_value=rng.choice(values[kind]) if kind in values else None, agent_id=[None, "", "a"][rng.integers(0, 3)]))
        events += mine
        want[f"t{t}"] = plain_fold(None, sorted(mine, key=lambda e: (e["event_time"], e["event_id"])))
    got = {r["ticket_id"]: r for r in at(spark, [], [{k: v for k, v in e.items()} for e in events], H + 60 * M).collect()}
    assert set(got) == {t for t, s in want.items() if s}
    for t, s in want.items():
        if s:
            r = got[t]
            assert (r["status"], r["priority"], r["message_count"], r["reopen_count"], r["escalation_count"], r["applied_event_count"], r["rejected_event_count"]) == (s["status"], s["priority"], s["m"], s["r"], s["x"], s["ok"], s["bad"]), t
            assert r["assigned_agent"] == s["agent"] and (r["resolved_at"] is None) == (s["done"] is None)


def sla(spark, contracts, as_of, events=(), **values):
    rows = state.ticket_state(frame(spark, "tickets", [ticket(**values)]), frame(spark, "ticket_events", list(events)), contract(spark, contracts), as_of)
    return rows.first()


def test_contract_choice(spark):
    terms = {"customer_id": "c", "priority": "P3", "support_tier": "Premium", "resolution_sla_minutes": 60}
    day = H.date()
    assert sla(spark, [terms | {"contract_id": "k", "effective_from": day, "effective_to": day}], H + M)["contract_id"] == "k"
    for outside in ({"effective_from": day + timedelta(days=1)}, {"effective_to": day - timedelta(days=1)}, {"priority": "P1"}, {"customer_id": "other"}):
        row = sla(spark, [terms | {"contract_id": "k"} | outside], H + M)
        assert [row[c] for c in ("contract_id", "support_tier", "resolution_sla_minutes", "sla_deadline", "minutes_to_sla")] == [None] * 5
    many = [terms | {"contract_id": i, "effective_from": f} for i, f in (("z", date(2024, 1, 1)), ("a", date(2025, 1, 1)), ("b", date(2025, 1, 1)))]
    assert sla(spark, many, H + M)["contract_id"] == "b"


def test_minutes_to_sla(spark):
    terms = [{"contract_id": "k", "customer_id": "c", "priority": "P3", "resolution_sla_minutes": 60}, {"contract_id": "q", "customer_id": "c", "priority": "P1", "resolution_sla_minutes": 15}]
    for after, left in ((45 * M, 15), (60 * M, 0), (60 * M + timedelta(seconds=1), -1), (200 * M, -140)):
        assert sla(spark, terms, H + after)["minutes_to_sla"] == left
    assert sla(spark, terms, H + 20 * M, [event(1, "priority_changed", 10, new_value="P1")])["minutes_to_sla"] == -5


def test_no_python_in_the_plan(spark, sf):
    from tidewell.plans import queries as Q

    plan = Q._states(spark, sf, Q.AS_OF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_summary_of_nothing(spark):
    rows = state.ticket_state(frame(spark, "tickets", []), frame(spark, "ticket_events", []), contract(spark, []), H)
    assert state.summary(rows).first().asDict() == {"tickets": 0, "applied_events": 0, "rejected_events": 0, "breaches": 0, "without_sla": 0}
    assert rows.select(F.count("*")).first()[0] == 0
