"""Published snapshots: each build computes one and replaces it, and only it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..functions.expr import exact_hour
from ..operators import features, gold, learning
from ..sources.store import Store
from . import silver

_TICK = timedelta(microseconds=1)


def _publish(store: Store, rows, name: str, column: str, value: datetime, run_id: str, layer: str = "gold") -> None:
    if not run_id.strip():
        raise ValueError("the run id must not be empty")
    store.replace_snapshot(rows.withColumn("_pipeline_run_id", F.lit(run_id)), layer, name, column, value)


def build_operations(store: Store, hour: datetime, run_id: str) -> None:
    hour = exact_hour(hour)
    states = silver.states(store, hour + timedelta(hours=1) - _TICK)
    _publish(store, gold.operations(states, silver._known(store, "accounts"), hour), "support_operations", "hour", hour, run_id)


def build_health(store: Store, as_of: datetime, run_id: str) -> None:
    as_of = exact_hour(as_of)
    _publish(store, gold.health(silver.states(store, as_of - _TICK), silver._known(store, "accounts"), as_of), "customer_support_health", "as_of", as_of, run_id)


def build_incidents(store: Store, hour: datetime, run_id: str) -> None:
    hour = exact_hour(hour)
    states = silver.states(store, hour + timedelta(hours=1) - _TICK)
    _publish(store, gold.incidents(states, silver._known(store, "products"), hour), "incident_signals", "time_window", hour, run_id)


def build_features(store: Store, as_of: datetime, run_id: str) -> None:
    as_of = exact_hour(as_of)
    rows = features.features(silver.states(store, as_of - _TICK), silver._known(store, "accounts"), silver._known(store, "ticket_events"), as_of)
    _publish(store, rows, "ticket_features", "as_of", as_of, run_id)


def build_backfill(store: Store, before: datetime, run_id: str) -> None:
    """Backfilled features replace those of earlier backfills before the same instant; later ones and operational snapshots stay."""
    before = exact_hour(before)
    if not run_id.strip():
        raise ValueError("the run id must not be empty")
    known = store.read("gold", "ticket_features") if store.exists("gold", "ticket_features") else None
    features.check_backfill(silver._known(store, "ticket_events"), known, before)
    rows = features.backfill(silver._known(store, "tickets"), silver._known(store, "contracts"), silver._known(store, "accounts"), before)
    store.replace_range(rows.withColumn("_pipeline_run_id", F.lit(f"backfill_{run_id}")), "gold", "ticket_features", "as_of", before, "backfill")


def build_training(store: Store, run_id: str, label_as_of: datetime, train_end: datetime, validation_end: datetime, test_end: datetime) -> dict[str, int]:
    periods = label_as_of, train_end, validation_end, test_end
    learning.check_periods(*periods)
    rows = learning.training_frame(store.read("gold", "ticket_features"), silver.states(store, exact_hour(label_as_of)), *periods)
    _publish(store, rows, "training_dataset", "label_as_of", exact_hour(label_as_of), run_id, "ml")
    made = store.read("ml", "training_dataset").where(F.col("label_as_of") == F.lit(exact_hour(label_as_of)))
    return {r["split"]: r["rows"] for r in learning.split_counts(made).collect()}
