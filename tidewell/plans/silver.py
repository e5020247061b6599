"""Validation runs: decide once, freeze the decisions, publish from them, mark completion last."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from hashlib import sha256

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schema
from ..operators import quality
from ..operators.state import summary, ticket_state
from ..sources.store import Store

_COUNTS = ("records_read", "accepted_count", "duplicate_count", "quarantine_count")
_METRICS = "pipeline_run_id string, source string, records_read bigint, accepted_count bigint, duplicate_count bigint, quarantine_count bigint, measured_at timestamp"


def _known(store: Store, entity: str):
    """The validated table, or an empty one."""
    if store.exists("silver", entity):
        return store.read("silver", entity)
    return store.spark.createDataFrame([], schema.typed(entity))


def run(store: Store, entity: str, run_id: str, now: datetime | None = None, tolerance: timedelta = timedelta(minutes=5)) -> dict:
    """Validate the landed rows of an entity under a run id; a repeated run id finishes or returns what it decided first.

    The staged decisions include rows of the first attempt only, even none: input that arrives before a
    retry waits for the next run id.
    """
    if entity not in schema.FIELDS or not run_id.strip():
        raise ValueError("unknown entity or empty run id")
    now = now or datetime.now(UTC)
    if store.exists("ops", "quality_metrics"):
        done = store.read("ops", "quality_metrics").where((F.col("pipeline_run_id") == run_id) & (F.col("source") == entity)).first()
        if done:
            return done.asDict()
    # Any run id may be given; its hash is safe in a path.
    stage = f"{store.path('ops', 'silver_evaluations')}/{entity}/run={sha256(run_id.encode()).hexdigest()[:32]}"
    if not store.files.exists(f"{stage}/_SUCCESS"):
        rows = store.read("bronze", entity)
        decided = quality.classify(rows, entity, now, _known(store, "accounts"), _known(store, "products"), _known(store, entity), tolerance)
        decided.withColumn("detected_at", F.lit(now)).write.mode("overwrite").parquet(stage)
    decided = store.spark.read.parquet(stage)
    accepted = decided.where(F.col("disposition") == quality.ACCEPTED)
    good = accepted.select("record.*", *[c for c, _ in schema.METADATA], F.col("detected_at").alias("_validated_at"), F.lit(run_id).alias("_validation_run_id"))
    store.insert_only(good, "silver", entity, [schema.KEYS[entity]])
    bad = decided.where(F.col("disposition") == quality.QUARANTINED)
    bad = bad.select("record_id", F.lit(entity).alias("source"), "raw_payload", "failure_reason", "detected_at", F.lit(run_id).alias("pipeline_run_id")).dropDuplicates(["record_id"])
    store.insert_only(bad, "ops", "invalid_records", ["record_id"])
    counts = quality.metrics(decided).first().asDict()
    row = {"pipeline_run_id": run_id, "source": entity, **counts, "measured_at": now}
    store.insert_only(store.spark.createDataFrame([tuple(row.values())], _METRICS), "ops", "quality_metrics", ["pipeline_run_id", "source"])
    return row


def run_all(store: Store, run_id: str, now: datetime | None = None, tolerance: timedelta = timedelta(minutes=5)) -> dict[str, dict]:
    """All entities in the order of their references, then the current ticket states."""
    now = now or datetime.now(UTC)
    done = {e: run(store, e, run_id, now, tolerance) for e in schema.ORDER if store.exists("bronze", e)}
    done["ticket_state"] = build_state(store, now, run_id)
    return done


def bootstrap(store: Store) -> list[str]:
    """The landing and validated tables of all entities, empty, where they aren't there yet; the names of those made."""
    lineage = StructType.fromDDL(", ".join(f"{c} {t}" for c, t in schema.METADATA))
    judged = StructType.fromDDL("_validated_at timestamp, _validation_run_id string")
    made = []
    for entity in schema.ORDER:
        for layer, kind in (("bronze", [*schema.raw(entity), *lineage]), ("silver", [*schema.typed(entity), *lineage, *judged])):
            # The stream lays out its own landing table.
            if (layer, entity) != ("bronze", "ticket_events") and not store.exists(layer, entity):
                store.create(layer, entity, store.spark.createDataFrame([], StructType(kind)))
                made.append(f"{layer}.{entity}")
    return made


def states(store: Store, as_of: datetime):
    return ticket_state(_known(store, "tickets"), _known(store, "ticket_events"), _known(store, "contracts"), as_of)


def build_state(store: Store, as_of: datetime, run_id: str) -> dict:
    store.replace(states(store, as_of).withColumn("_state_run_id", F.lit(run_id)), "silver", "ticket_state")
    return summary(store.read("silver", "ticket_state")).first().asDict()
