"""Landing of event files: restart, repeats, late, malformed and future events, replay."""

import json
import os
from datetime import datetime, timedelta

import pytest

from tidewell.functions.expr import UTC
from tidewell.plans import silver
from tidewell.sources import generate
from tidewell.sources.store import Store
from tidewell.streaming import landing

T0 = datetime(2026, 1, 1, 10, tzinfo=UTC)


def line(i, minutes, **more):
    moment = (T0 + timedelta(minutes=minutes)).isoformat() if isinstance(minutes, (int, float)) else minutes
    return json.dumps({"event_id": i, "ticket_id": "t", "customer_id": "c", "product_id": "p", "event_type": "customer_replied", "event_time": moment} | more)


def put(folder, n, lines):
    folder.mkdir(exist_ok=True)
    file = folder / f"events_{n:06d}.json"
    file.write_text("\n".join(lines) + "\n")
    os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))


def metrics(store):
    return [tuple(r) for r in store.read("ops", "streaming_metrics").orderBy("batch_id").select("batch_id", "rows_read", "rows_written", "duplicate_rows", "malformed_rows", "late_rows").collect()]


def test_stream(spark, tmp_path):
    store, src = Store(spark, f"{tmp_path}/w"), tmp_path / "src"
    run = lambda: landing.run_stream(store, str(src), f"{tmp_path}/cp", "r", tolerance=timedelta(minutes=30))
    put(src, 1, [line("e1", 0), line("e2", 5), line("e2", 5), "not json", "", "{}}", line("x", 1) + " junk"])
    assert run()["batches"] == 1
    put(src, 2, [line("e3", 60), line("e1", 0), line("e1", 0, payload="{}"), "not json"])
    put(src, 3, [line("e4", 10), line("e5", 90), line("e6", 60 * 24 * 365 * 70), line("e7", "soon")])
    assert run()["batches"] == 2
    assert metrics(store) == [(0, 6, 5, 1, 3, 0), (1, 4, 3, 1, 1, 0), (2, 4, 4, 0, 0, 1)]
    rows = {r["event_id"]: r["_is_late"] for r in store.read("bronze", "ticket_events").collect() if r["event_id"] and r["event_id"] != "e1"}
    assert rows == {"e2": False, "e3": False, "e4": True, "e5": False, "e6": False, "e7": None}
    assert store.read("bronze", "ticket_events").where("event_id = 'e1'").count() == 2
    tops = [r["max_event_time"] for r in store.read("ops", "streaming_metrics").orderBy("batch_id").collect()]
    assert tops[2] == tops[1] + timedelta(minutes=30)
    before = metrics(store)
    assert run()["batches"] == 0 and metrics(store) == before


def test_replay_after_a_crash(spark, tmp_path, monkeypatch):
    store = Store(spark, f"{tmp_path}/w")
    batch = spark.createDataFrame([(line("a", 0), "f1"), (line("b", 1), "f1"), ("oops", "f1"), ("oops", "f2")], "value string, _source_file string")
    insert = Store.insert_only

    def torn(self, rows, layer, name, *keys):
        if name == "streaming_metrics":
            raise RuntimeError("crash")
        insert(self, rows, layer, name, *keys)

    monkeypatch.setattr(Store, "insert_only", torn)
    land = lambda: landing.land_batch(store, batch, 0, "s", "r", timedelta(minutes=5))
    with pytest.raises(RuntimeError):
        land()
    monkeypatch.setattr(Store, "insert_only", insert)
    land()
    land()
    assert metrics(store) == [(0, 4, 4, 0, 2, 0)] and store.read("bronze", "ticket_events").count() == 4


def test_guards(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for bad in ({"stream": "a/b"}, {"run_id": " "}, {"files_per_batch": 0}, {"tolerance": timedelta(minutes=-1)}):
        with pytest.raises(ValueError):
            landing.run_stream(store, "x", "y", **({"run_id": "r"} | bad))


def test_generated_stream_replays_without_rejections(spark, tmp_path):
    c = generate.Streamed(10, 3, T0, tickets=6, malformed=1, invalid=2, late_rate=0.0)
    generate.write_batches(tmp_path / "src", c, 12)
    store = Store(spark, f"{tmp_path}/w")
    landing.run_stream(store, str(tmp_path / "src"), f"{tmp_path}/cp", "r", files_per_batch=12)
    p = generate.Profile(customers=10, products=3, tickets=5)
    for name, rows in (("accounts", generate.accounts(spark, p)), ("products", generate.products(spark, p))):
        store.append(rows, "silver", name)
    done = silver.run(store, "ticket_events", "r", datetime(2027, 1, 1, tzinfo=UTC))
    assert done["quarantine_count"] == 36 and done["accepted_count"] > 100
    state = silver.build_state(store, datetime(2027, 1, 1, tzinfo=UTC), "r")
    assert state["rejected_events"] == 0 and state["applied_events"] == done["accepted_count"]
