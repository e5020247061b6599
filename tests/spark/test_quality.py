"""Validation rules and the run protocol."""

from datetime import datetime, timedelta

import pytest
from helpers import frame
from pyspark.sql import functions as F

from tidewell import schema
from tidewell.functions.expr import UTC
from tidewell.operators import quality
from tidewell.plans import silver
from tidewell.sources import store as stores

NOW = datetime(2026, 1, 1, tzinfo=UTC)
EVENT = {"event_id": "e", "ticket_id": "t", "customer_id": "c", "product_id": "p", "event_type": "customer_replied", "event_time": "2025-01-01T00:00:00Z"}
TICKET = {f: "x" for f in schema.names("tickets")} | {
    "ticket_id": "t", "customer_id": "c", "product_id": "p", "created_at": "2025-01-01T00:00:00Z", "closed_at": None, "priority": "p1", "final_status": "Open", "escalated": "TRUE", "sla_breached": "false",
}
ACCOUNT = {f: "x" for f in schema.names("accounts")} | {"customer_id": "c", "segment": "smb", "region": "EUROPE", "annual_contract_value": "10.5", "support_tier": "premium"}
CONTRACT = {"contract_id": "k", "customer_id": "c", "support_tier": "Premium", "priority": "P1", "response_sla_minutes": "5", "resolution_sla_minutes": "60", "effective_from": "2025-01-01", "effective_to": None}
BASE = {"ticket_events": EVENT, "tickets": TICKET, "accounts": ACCOUNT, "contracts": CONTRACT}


def raw(spark, entity, rows, corrupt=False):
    names = schema.names(entity) + ["_corrupt_record"] * corrupt
    ddl = ", ".join(f"{n} string" for n in names)
    made = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)
    return made.withColumn("_ingested_at", F.lit(NOW)).withColumn("_source_file", F.lit("f")).withColumn("_pipeline_run_id", F.lit("r")).withColumn("_record_hash", F.sha2(F.concat_ws("|", *made.columns), 256))


def judge(spark, entity, rows, **more):
    ids = lambda e, k, v: frame(spark, e, [{k: v}])
    return quality.classify(raw(spark, entity, rows, **more), entity, NOW, ids("accounts", "customer_id", "c"), ids("products", "product_id", "p"))


CASES = [
    ("ticket_events", "event_id", "  ", "event_id: required"), ("ticket_events", "event_time", "2025-01-01T00:00:00", "event_time: invalid timestamp"), ("ticket_events", "event_time", "10:00:00Z", "event_time: invalid timestamp"),
    ("ticket_events", "event_type", "teleported", "event_type: unsupported value"), ("ticket_events", "payload", "[1]", "payload: invalid JSON object"), ("ticket_events", "payload", "{}}", "payload: invalid JSON object"),
    ("ticket_events", "payload", "{} {}", "payload: invalid JSON object"), ("ticket_events", "payload", "{},{}", "payload: invalid JSON object"), ("ticket_events", "payload", "nope", "payload: invalid JSON object"), ("ticket_events", "payload", '"s"', "payload: invalid JSON object"),
    ("ticket_events", "customer_id", "nobody", "customer_id: unknown customer"), ("ticket_events", "product_id", "nothing", "product_id: unknown product"), ("ticket_events", "event_time", "2026-01-01T00:05:01Z", "event_time: future timestamp outside tolerance"),
    ("tickets", "priority", "URGENT", "priority: unsupported value"), ("tickets", "final_status", "lost", "final_status: unsupported value"), ("tickets", "escalated", "1", "escalated: invalid boolean"), ("tickets", "closed_at", "2024-01-01T00:00:00Z", "closed_at: before created_at"),
    ("accounts", "annual_contract_value", "NaN", "annual_contract_value: invalid double"), ("accounts", "annual_contract_value", "inf", "annual_contract_value: invalid double"), ("accounts", "annual_contract_value", "-1", "annual_contract_value: outside allowed range"), ("accounts", "segment", "Tiny", "segment: unsupported value"),
    ("accounts", "region", "Moon", "region: unsupported value"), ("accounts", "support_tier", "Gold", "support_tier: unsupported value"),
    ("contracts", "response_sla_minutes", "1.5", "response_sla_minutes: invalid integer"), ("contracts", "resolution_sla_minutes", "2147483648", "resolution_sla_minutes: invalid integer"), ("contracts", "resolution_sla_minutes", "0", "resolution_sla_minutes: outside allowed range"),
    ("contracts", "effective_from", "2025", "effective_from: invalid date"), ("contracts", "effective_to", "2024-12-31", "effective_to: before effective_from"),
]


def test_rules(spark):
    for entity in BASE:
        mine = [(f, v, reason) for e, f, v, reason in CASES if e == entity]
        rows = [BASE[entity] | {f: v} for f, v, _ in mine] + [BASE[entity]]
        got = judge(spark, entity, rows).select(*[F.col(c) for c in schema.names(entity)], "disposition", "failure_reason").collect()
        by = {tuple(r[c] for c in schema.names(entity)): (r["disposition"], r["failure_reason"]) for r in got}
        for (_, _, reason), row in zip(mine, rows):
            assert by[tuple(row.get(c) for c in schema.names(entity))] == ("quarantined", reason)
        assert by[tuple(rows[-1].get(c) for c in schema.names(entity))] == ("accepted", None)


def test_values(spark):
    r = judge(spark, "tickets", [TICKET | {"ticket_id": "\t t ", "created_at": "2025-01-01T02:00:00+02:00"}]).select("record.*").first()
    assert (r["ticket_id"], r["priority"], r["final_status"], r["escalated"], r["closed_at"]) == ("t", "P1", "open", True, None) and r["created_at"].hour == 0
    many = judge(spark, "ticket_events", [EVENT | {"event_id": str(i), **v} for i, v in enumerate(({"event_type": "PRIORITY_CHANGED", "new_value": "p2"}, {"event_type": "status_changed", "new_value": "CLOSED"}, {"event_type": "status_changed"}, {"event_type": "ticket_created", "new_value": "urgent"}, {"payload": '{"a": {"b": "}"}}'}, {"event_time": "2026-01-01T00:05:00Z"}))])
    got = {r["event_id"]: (r["disposition"], r["record"]["new_value"], r["failure_reason"]) for r in many.collect()}
    assert got == {"0": ("accepted", "P2", None), "1": ("accepted", "closed", None), "2": ("quarantined", None, "new_value: invalid status"), "3": ("quarantined", "urgent", "new_value: invalid priority"), "4": ("accepted", None, None), "5": ("accepted", None, None)}
    null = judge(spark, "tickets", [TICKET | {"customer_id": None}]).first()["failure_reason"]
    assert null == "customer_id: required; customer_id: unknown customer"
    torn = judge(spark, "ticket_events", [{"_corrupt_record": "x"}], corrupt=True).first()["reasons"]
    assert torn[0] == "record: malformed source line" and "event_id: required" in torn


def test_typed_schema(spark):
    assert schema.typed("contracts")["effective_to"].nullable and not schema.typed("contracts")["contract_id"].nullable


def test_first_valid_takes_the_key(spark):
    rows = [TICKET, TICKET | {"subject": "again"}, TICKET | {"priority": "bad"}]
    got = sorted(r["disposition"] for r in judge(spark, "tickets", rows).collect())
    assert got == ["accepted", "quarantined", "rejected_duplicate"]


@pytest.fixture
def store(spark, tmp_path):
    made = stores.Store(spark, f"{tmp_path}/w")
    made.append(frame(spark, "accounts", [{"customer_id": "c"}]), "silver", "accounts")
    made.append(frame(spark, "products", [{"product_id": "p"}]), "silver", "products")
    return made


def test_run_survives_a_crash(spark, store, monkeypatch):
    """A run that fails before its evidence is written decides nothing anew when it is repeated, whatever arrived meanwhile."""
    good = [TICKET | {"ticket_id": f"ok-{i}"} for i in range(3)]
    twice = [TICKET | {"ticket_id": "ok-1", "subject": s} for s in ("b", "c")]
    bad = [TICKET | {"ticket_id": f"no-{i}", "priority": "none"} for i in range(2)]
    store.append(raw(spark, "tickets", good + twice + bad), "bronze", "tickets")
    whole = stores.Store.insert_only

    def torn(self, rows, layer, name, *more):
        if name == "invalid_records":
            raise RuntimeError("crash")
        whole(self, rows, layer, name, *more)

    monkeypatch.setattr(stores.Store, "insert_only", torn)
    with pytest.raises(RuntimeError):
        silver.run(store, "tickets", "../first", NOW)
    monkeypatch.setattr(stores.Store, "insert_only", whole)
    store.append(raw(spark, "tickets", [TICKET | {"ticket_id": "meanwhile"}]), "bronze", "tickets")
    counts = lambda r: [r[c] for c in ("records_read", "accepted_count", "duplicate_count", "quarantine_count")]
    assert counts(silver.run(store, "tickets", "../first", NOW)) == [7, 3, 2, 2] == counts(silver.run(store, "tickets", "../first", NOW))
    assert counts(silver.run(store, "tickets", "second", NOW + timedelta(minutes=1))) == [8, 1, 5, 2]
    assert store.read("silver", "tickets").count() == 4 and store.read("ops", "invalid_records").count() == 2


def test_snapshots_replace_only_themselves(spark, tmp_path):
    s = stores.Store(spark, str(tmp_path))
    for hour, n in ((1, 3), (2, 2), (1, 0)):
        s.replace_snapshot(spark.range(n).withColumn("h", F.lit(hour)), "gold", "incident_signals", "time_window", NOW.replace(hour=hour))
    assert [r["h"] for r in s.read("gold", "incident_signals").collect()] == [2, 2]


def test_merges(spark, tmp_path):
    s = stores.Store(spark, str(tmp_path))
    rows = lambda *r: spark.createDataFrame(r, "k int, v string")
    s.create("ops", "spark_performance_runs", rows((0, "x")))
    s.create("ops", "spark_performance_runs", rows((0, "x")))
    assert s.read("ops", "spark_performance_runs").count() == 0
    s.insert_only(rows((1, "a"), (2, "b")), "ops", "spark_performance_runs", ["k"])
    s.insert_only(rows((2, "c"), (3, "d")), "ops", "spark_performance_runs", ["k"])
    s.update_only(rows((3, "e"), (4, "f")), "ops", "spark_performance_runs", ["k"])
    assert sorted(map(tuple, s.read("ops", "spark_performance_runs").collect())) == [(1, "a"), (2, "b"), (3, "e")]
    s.replace(rows((9, "z")), "ops", "spark_performance_runs")
    assert [tuple(r) for r in s.read("ops", "spark_performance_runs").collect()] == [(9, "z")]
    with pytest.raises(ValueError):
        s.path("ops", "nothing")


def test_jobs_end_to_end(spark, tmp_path):
    from tidewell.plans import snapshots
    from tidewell.sources import batch, generate

    p = generate.Profile(customers=20, products=4, tickets=500, invalid_tickets=8, breach_rate=0.3)
    made = generate.write_dataset(spark, f"{tmp_path}/raw", p)
    assert made["tickets"]["rows"] == 508
    s = stores.Store(spark, f"{tmp_path}/w")
    for e in ("products", "accounts", "contracts", "tickets"):
        landed = batch.ingest(s, e, f"{tmp_path}/raw/{e}", "r")
        assert landed.rows_read == made[e]["rows"] == landed.rows_written
        assert batch.ingest(s, e, f"{tmp_path}/raw/{e}", "r2").rows_written == 0
    done = silver.run_all(s, "r", datetime(2027, 1, 1, tzinfo=UTC))
    assert (done["tickets"]["accepted_count"], done["tickets"]["quarantine_count"]) == (500, 8) and done["ticket_state"]["tickets"] == 500
    hour = datetime(2025, 6, 1, 12, tzinfo=UTC)
    snapshots.build_operations(s, hour, "r")
    snapshots.build_health(s, hour, "r")
    snapshots.build_incidents(s, hour, "r")
    assert s.read("gold", "customer_support_health").count() == 20 and s.read("gold", "incident_signals").count() == 4
    snapshots.build_backfill(s, datetime(2026, 1, 1, tzinfo=UTC), "r")
    counts = snapshots.build_training(s, "r", datetime(2027, 1, 1, tzinfo=UTC), datetime(2025, 7, 1, tzinfo=UTC), datetime(2025, 10, 1, tzinfo=UTC), datetime(2026, 1, 1, tzinfo=UTC))
    assert set(counts) == {"train", "validation", "test"}
    states = s.read("silver", "tickets").join(s.read("silver", "ticket_state").select("ticket_id", "resolved_at", "sla_deadline"), "ticket_id")
    assert states.where(F.col("sla_breached") != (F.col("resolved_at") > F.col("sla_deadline"))).count() == 0
