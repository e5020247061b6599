"""Typed frames from few values: fields not given get a filler of their type."""

from datetime import UTC, datetime

from tidewell import schema

H = datetime(2026, 1, 1, 12, tzinfo=UTC)
FILL = {"string": "-", "timestamp": H, "double": 0.0, "int": 1, "boolean": False, "date": H.date()}


def frame(spark, entity, rows):
    full = [tuple(r.get(f, FILL[t] if required else None) for f, t, required in schema.FIELDS[entity]) for r in rows]
    return spark.createDataFrame(full, schema.typed(entity))


def contract(spark, rows):
    base = {"effective_from": datetime(2020, 1, 1).date()}
    return frame(spark, "contracts", [base | r for r in rows])
