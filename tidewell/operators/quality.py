"""Record validation: typed values, reasons and a disposition for every landed row, in native expressions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import at, day, filled, finite, instant, json_object, truth, whole
from ..schema import ENUMS, EVENT_TYPES, FIELDS, KEYS, STATUSES

ACCEPTED, DUPLICATE, QUARANTINED = "accepted", "rejected_duplicate", "quarantined"
_PARSE = {"timestamp": instant, "date": day, "boolean": truth, "int": whole, "double": finite}
_WORD = {"timestamp": "timestamp", "date": "date", "boolean": "boolean", "int": "integer", "double": "double"}
#: Fields that must name a known row, by entity.
REFERENCES = {"contracts": ("customer_id",), "tickets": ("customer_id", "product_id"), "ticket_events": ("customer_id", "product_id")}


def _canonical(value: Column, choices: tuple[str, ...]) -> Column:
    found = F.lit(None).cast("string")
    for choice in choices:
        found = F.when(F.lower(value) == choice.lower(), choice).otherwise(found)
    return found


def evaluate(rows: DataFrame, entity: str, now: datetime, tolerance: timedelta = timedelta(minutes=5)) -> DataFrame:
    """``rows`` (all text) with ``record`` (typed values), ``reasons`` and ``raw_payload``.

    ``_customer_exists`` and ``_product_exists`` are taken from the rows where the entity has references. Reasons come in a fixed
    order: the line itself, each field, enumerations, references, statuses, payload, ranges, order of instants, future instants.
    """
    if tolerance < timedelta(0):
        raise ValueError("the tolerance must not be negative")
    fields = FIELDS[entity]
    when = lambda condition, text: F.when(condition, F.lit(text))
    text = {f: filled(F.col(f)) for f, _, _ in fields}
    staged = rows.select("*", *[text[f].alias(f"_t_{f}") for f in text])
    given = {f: F.col(f"_t_{f}") for f in text}
    value = {f: _PARSE[t](given[f]) if t in _PARSE else given[f] for f, t, _ in fields}
    reasons = [when(F.col("_corrupt_record").isNotNull(), "record: malformed source line")] if "_corrupt_record" in rows.columns else []
    for f, kind, required in fields:
        missing = when(given[f].isNull(), f"{f}: required") if required else F.lit(None).cast("string")
        reasons.append(F.coalesce(missing, when(given[f].isNotNull() & value[f].isNull(), f"{f}: invalid {_WORD[kind]}")) if kind in _WORD else missing)
    for f, choices in ENUMS.items():
        if f in value:
            canonical = _canonical(value[f], choices)
            reasons.append(when(value[f].isNotNull() & canonical.isNull(), f"{f}: unsupported value"))
            value[f] = canonical
    for f in REFERENCES.get(entity, ()):
        what = f.removesuffix("_id")
        reasons.append(when(~F.col(f"_{what}_exists"), f"{f}: unknown {what}"))
    if entity == "tickets":
        value["final_status"] = F.lower(value["final_status"])
        reasons.append(when(~value["final_status"].isin(*STATUSES), "final_status: unsupported value"))
    if entity == "ticket_events":
        kind = F.lower(value["event_type"])
        reasons.append(when(~kind.isin(*EVENT_TYPES), "event_type: unsupported value"))
        reasons.append(when(value["payload"].isNotNull() & ~json_object(value["payload"]), "payload: invalid JSON object"))
        upper, lower = F.upper(value["new_value"]), F.lower(value["new_value"])
        ranked, moved = kind.isin("priority_changed", "ticket_created"), kind == "status_changed"
        good_rank, good_move = F.coalesce(upper.isin(*ENUMS["priority"]), F.lit(False)), F.coalesce(lower.isin(*STATUSES), F.lit(False))
        reasons += [when(ranked & ~good_rank, "new_value: invalid priority"), when(moved & ~good_move, "new_value: invalid status")]
        value |= {"event_type": kind, "new_value": F.when(ranked & good_rank, upper).when(moved & good_move, lower).otherwise(value["new_value"])}
    for f in ("annual_contract_value", "response_sla_minutes", "resolution_sla_minutes"):
        if f in value:
            reasons.append(when(value[f] < 0 if f == "annual_contract_value" else value[f] <= 0, f"{f}: outside allowed range"))
    for first, last in (("created_at", "closed_at"), ("effective_from", "effective_to")):
        if first in value:
            reasons.append(when(value[last] < value[first], f"{last}: before {first}"))
    for f in ("created_at", "closed_at", "event_time"):
        if f in value:
            reasons.append(when(value[f] > at(now + tolerance), f"{f}: future timestamp outside tolerance"))
    record = F.struct(*[value[f].alias(f) for f, _, _ in fields])
    evidence = [c for c in sorted(rows.columns) if c not in ("_customer_exists", "_product_exists", "_existing")]
    raw = F.to_json(F.struct(*evidence), {"ignoreNullFields": "false"})
    return staged.select(*rows.columns, record.alias("record"), F.array_compact(F.array(*reasons)).alias("reasons"), raw.alias("raw_payload"))


def with_references(rows: DataFrame, entity: str, customers: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """Flags whether the stripped customer and product ids are known; a null id isn't."""
    for f, known in (("customer_id", customers), ("product_id", products)):
        if f in REFERENCES.get(entity, ()):
            flag = f"_{f.removesuffix('_id')}_exists"
            ids = known.select(F.col(f).alias("_id"), F.lit(True).alias(flag)).distinct()
            rows = rows.join(ids, filled(rows[f]) == ids["_id"], "left").drop("_id").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return rows


def classify(rows: DataFrame, entity: str, now: datetime, customers: DataFrame | None = None, products: DataFrame | None = None, existing: DataFrame | None = None, tolerance: timedelta = timedelta(minutes=5)) -> DataFrame:
    """Evaluated rows with disposition, failure_reason and record_id.

    Rows with reasons are quarantined and never take a key. Of the rest, a key that ``existing`` has, or that an earlier row
    (by _ingested_at, then _record_hash) takes, is a duplicate.
    """
    key = KEYS[entity]
    rows = with_references(rows, entity, customers, products)
    if existing is not None:
        ids = existing.select(F.col(key).alias("_id"), F.lit(True).alias("_existing")).distinct()
        rows = rows.join(ids, filled(rows[key]) == ids["_id"], "left").drop("_id")
    else:
        rows = rows.withColumn("_existing", F.lit(None).cast("boolean"))
    seen = evaluate(rows, entity, now, tolerance)
    state = F.when(F.size("reasons") > 0, QUARANTINED).when(F.col("_existing"), DUPLICATE).otherwise(ACCEPTED)
    seen = seen.withColumn("disposition", state)
    # Only accepted rows compete, and all of them have a key; the others are dealt out by their hash.
    rivals = F.when(F.col("disposition") == ACCEPTED, F.col(f"record.{key}")).otherwise(F.col("_record_hash"))
    first = Window.partitionBy(rivals, "disposition").orderBy("_ingested_at", "_record_hash")
    seen = seen.withColumn("_n", F.row_number().over(first))
    seen = seen.withColumn("disposition", F.when((F.col("disposition") == ACCEPTED) & (F.col("_n") > 1), DUPLICATE).otherwise(F.col("disposition")))
    reason = F.when(F.size("reasons") > 0, F.array_join("reasons", "; "))
    ident = F.sha2(F.concat_ws("\n", F.lit(entity), "raw_payload"), 256)
    return seen.withColumn("failure_reason", reason).withColumn("record_id", ident).drop("_n", "_existing", "_customer_exists", "_product_exists")


def metrics(classified: DataFrame) -> DataFrame:
    """Rows read, accepted, duplicate and quarantined."""
    count = lambda d: F.count_if(F.col("disposition") == d)
    return classified.agg(F.count("*").alias("records_read"), count(ACCEPTED).alias("accepted_count"), count(DUPLICATE).alias("duplicate_count"), count(QUARANTINED).alias("quarantine_count"))
