"""Entities, their fields and the enumerations of the support domain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

# Fields by entity as name, type, required.
FIELDS = {
    "products": (("product_id", "string", True), ("product_name", "string", True), ("product_family", "string", True), ("service_owner", "string", True), ("criticality", "string", True)),
    "accounts": (
        ("customer_id", "string", True), ("customer_name", "string", True), ("segment", "string", True), ("region", "string", True), ("industry", "string", True),
        ("annual_contract_value", "double", True), ("support_tier", "string", True), ("account_status", "string", True),
    ),
    "contracts": (
        ("contract_id", "string", True), ("customer_id", "string", True), ("support_tier", "string", True), ("priority", "string", True),
        ("response_sla_minutes", "int", True), ("resolution_sla_minutes", "int", True), ("effective_from", "date", True), ("effective_to", "date", False),
    ),
    "tickets": (
        ("ticket_id", "string", True), ("customer_id", "string", True), ("product_id", "string", True), ("created_at", "timestamp", True), ("closed_at", "timestamp", False),
        ("priority", "string", True), ("channel", "string", True), ("category", "string", True), ("subject", "string", True), ("description", "string", True),
        ("resolution", "string", False), ("final_status", "string", True), ("escalated", "boolean", True), ("sla_breached", "boolean", True), ("agent_id", "string", False),
    ),
    "ticket_events": (
        ("event_id", "string", True), ("ticket_id", "string", True), ("customer_id", "string", True), ("product_id", "string", True), ("event_type", "string", True),
        ("event_time", "timestamp", True), ("agent_id", "string", False), ("old_value", "string", False), ("new_value", "string", False), ("payload", "string", False),
    ),
}
KEYS = {"tickets": "ticket_id", "ticket_events": "event_id", "accounts": "customer_id", "contracts": "contract_id", "products": "product_id"}
# Fixed values.
ENUMS = {
    "priority": ("P1", "P2", "P3", "P4"),
    "support_tier": ("Standard", "Enhanced", "Premium"),
    "segment": ("SMB", "Mid-Market", "Enterprise", "Strategic"),
    "region": ("North America", "Europe", "Asia Pacific", "Latin America"),
}
ACTIVE = ("in_progress", "open", "pending_customer")
STATUSES = (*ACTIVE, "resolved", "closed")
EVENT_TYPES = ("ticket_created", "agent_assigned", "priority_changed", "status_changed", "customer_replied", "agent_replied", "engineering_escalated", "ticket_resolved", "ticket_reopened")
# Lineage columns.
METADATA = (("_ingested_at", "timestamp"), ("_source_file", "string"), ("_pipeline_run_id", "string"), ("_record_hash", "string"))
LAYERS = ("bronze", "silver", "gold", "ml", "ops")
TABLES = {
    "bronze": ("tickets", "ticket_events", "accounts", "contracts", "products"),
    "silver": ("tickets", "ticket_events", "accounts", "contracts", "products", "ticket_state"),
    "gold": ("support_operations", "ticket_features", "customer_support_health", "incident_signals"),
    "ml": ("training_dataset",),
    "ops": ("invalid_records", "quality_metrics", "streaming_metrics", "silver_evaluations", "spark_performance_runs"),
}
#: Entities in the order in which references need them.
ORDER = ("products", "accounts", "contracts", "tickets", "ticket_events")


@dataclass(frozen=True)
class Table:
    """A registered table: its layer and name."""

    layer: str
    name: str

    def __post_init__(self):
        if self.name not in TABLES.get(self.layer, ()):
            raise ValueError(f"unknown table {self.layer}.{self.name}")

    @property
    def path(self) -> str:
        return f"{self.layer}/{self.name}"


def names(entity: str) -> list[str]:
    return [f for f, _, _ in FIELDS[entity]]


def typed(entity: str) -> StructType:
    return StructType.fromDDL(", ".join(f"{f} {t}{' not null' if r else ''}" for f, t, r in FIELDS[entity]))


def raw(entity: str, corrupt: bool = False) -> StructType:
    """All fields as text, as the landing layer keeps them."""
    return StructType.fromDDL(", ".join([f"{f} string" for f in names(entity)] + ["_corrupt_record string"] * corrupt))
