"""Landing of JSON-line events from files: parse, label late rows, store each content once, record the batch last.

Late rows are kept and labelled, so Spark's own watermark, which drops them, isn't used: a batch's watermark is
the greatest event time of the batches before it, less the tolerance.
"""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions.expr import content_hash, us
from ..sources.store import Store

FIELDS = schema.names("ticket_events")
CORRUPT = "_corrupt_record"
_STREAM = re.compile(r"[A-Za-z0-9_]+")
_METRICS = (
    "stream_name string, batch_id bigint, pipeline_run_id string, rows_read bigint, rows_written bigint, duplicate_rows bigint, malformed_rows bigint, late_rows bigint, "
    "batch_max_event_time timestamp, max_event_time timestamp, watermark timestamp, processed_at timestamp, input_rows_per_second double, processed_rows_per_second double, batch_duration_ms bigint"
)


def parse(lines: DataFrame) -> DataFrame:
    """Event fields of the non-blank lines (``value``); a malformed line keeps its text in ``_corrupt_record`` and nothing else.

    The parser forgives trailing text, so a line must also begin and end with a brace and name a field.
    """
    ddl = ", ".join([f"{f} string" for f in FIELDS] + [f"{CORRUPT} string"])
    read = lines.where(F.trim("value") != "").withColumn("_p", F.from_json("value", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    braced = F.trim("value").startswith("{") & F.trim("value").endswith("}")
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull() | ~braced | F.coalesce(*[F.col(f"_p.{f}") for f in FIELDS]).isNull()
    kept = [c for c in lines.columns if c != "value"]
    return read.select(*kept, *[F.when(~bad, F.col(f"_p.{f}")).alias(f) for f in FIELDS], F.when(bad, F.col("value")).alias(CORRUPT))


def event_hash() -> Column:
    """Events are known by content; a malformed line by its file and text, as it has no identity of its own."""
    line = F.concat_ws("\n", F.lit("corrupt"), "_source_file", CORRUPT)
    return F.when(F.col(CORRUPT).isNotNull(), F.sha2(line, 256)).otherwise(content_hash(FIELDS))


def event_time() -> Column:
    return F.col("event_time").try_cast("timestamp")


def running_watermark(rows: DataFrame, batch: str, tolerance: timedelta) -> DataFrame:
    """For each batch the greatest event_time of the batches before, less the tolerance; null for the first.

    The window runs over one row per batch.
    """
    tops = rows.groupBy(batch).agg(F.max(us("event_time")).alias("top"))
    before = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    micros = tolerance // timedelta(microseconds=1)
    return tops.select(batch, F.timestamp_micros(F.max("top").over(before) - F.lit(micros)).alias("watermark"))


def labelled(lines: DataFrame, lineage: str, watermark: int | None) -> DataFrame:
    """Parsed lines (value, _source_file) with the label of late ones, which null times don't get, lineage and hash; of equal contents the one from the first file."""
    late = F.lit(False) if watermark is None else us(event_time()) < F.lit(watermark)
    rows = parse(lines).select(
        *FIELDS,
        CORRUPT,
        F.when(event_time().isNotNull(), late).alias("_is_late"),
        F.current_timestamp().alias("_ingested_at"),
        "_source_file",
        F.lit(lineage).alias("_pipeline_run_id"),
        event_hash().alias("_record_hash"),
    )
    rank = Window.partitionBy("_record_hash").orderBy("_source_file")
    return rows.withColumn("_n", F.row_number().over(rank)).where("_n = 1").drop("_n")


def counters(landed: DataFrame) -> DataFrame:
    """One row of what a batch left: rows written, malformed and late ones, the greatest event time, and when it was landed."""
    return landed.agg(
        F.count("*").alias("written"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed"),
        F.count_if("_is_late").alias("late"),
        # An event of the future doesn't move the watermark.
        F.max(F.when(event_time() <= F.col("_ingested_at"), us(event_time()))).alias("top"),
        us(F.max("_ingested_at")).alias("at"),
    )


def land_batch(store: Store, batch: DataFrame, batch_id: int, stream: str, run_id: str, tolerance: timedelta) -> None:
    """Land one batch of lines (value, _source_file). A finished batch is skipped; an interrupted one ends with the same counts.

    A batch is one labelled part of the table, there whole or not at all. Equal contents have equal event times, so a batch
    is held against the days it touches and not against the whole table.
    """
    spark = batch.sparkSession
    done = store.exists("ops", "streaming_metrics")
    known = store.read("ops", "streaming_metrics").where(F.col("stream_name") == stream) if done else None
    if done and not known.where(F.col("batch_id") == batch_id).isEmpty():
        return
    prior = known.where(F.col("batch_id") < batch_id).agg(us(F.max("max_event_time"))).first()[0] if done else None
    watermark = None if prior is None else prior - tolerance // timedelta(microseconds=1)
    lineage = f"{stream}/{batch_id}"
    mine = store.labelled("bronze", "ticket_events", lineage)
    if mine is None:
        day = F.coalesce(F.date_format(event_time(), "yyyyMMdd"), F.lit("none"))
        store.insert_only(labelled(batch, lineage, watermark), "bronze", "ticket_events", ["_record_hash"], lineage, day)
        mine = store.labelled("bronze", "ticket_events", lineage)
    seen = counters(mine).first()
    read = parse(batch).count()
    top = max((x for x in (prior, seen["top"]) if x is not None), default=None)
    row = [stream, batch_id, run_id, read, seen["written"], read - seen["written"], seen["malformed"], seen["late"], seen["top"], top, watermark, seen["at"], None, None, None]
    ddl = _METRICS.replace(" timestamp", " bigint")
    metric = spark.createDataFrame([tuple(row)], ddl)
    instants = [c.split()[0] for c in _METRICS.split(", ") if c.endswith(" timestamp")]
    metric = metric.select(*[F.timestamp_micros(c).alias(c) if c in instants else F.col(c) for c in metric.columns])
    store.insert_only(metric, "ops", "streaming_metrics", ["stream_name", "batch_id"])


def record_progress(store: Store, progress: list, stream: str) -> int:
    """Add Spark's rates and durations to the batches' metrics; the number of batches that had rows."""
    rows = []
    for p in progress:
        get = (lambda k, p=p: p[k]) if isinstance(p, dict) else (lambda k, p=p: getattr(p, k))
        if get("numInputRows"):
            rows.append((stream, int(get("batchId")), float(get("inputRowsPerSecond") or 0), float(get("processedRowsPerSecond") or 0), int(get("batchDuration") or 0)))
    if rows:
        ddl = "stream_name string, batch_id bigint, input_rows_per_second double, processed_rows_per_second double, batch_duration_ms bigint"
        store.update_only(store.spark.createDataFrame(rows, ddl), "ops", "streaming_metrics", ["stream_name", "batch_id"])
    return len(rows)


def run_stream(store: Store, source: str, checkpoints: str, run_id: str, stream: str = "ticket_events", tolerance: timedelta = timedelta(minutes=60), files_per_batch: int = 1) -> dict:
    """Land every file ``events_*.json`` there is now, from where the stream's checkpoint left off, then stop."""
    if not _STREAM.fullmatch(stream):
        raise ValueError(f"invalid stream name {stream!r}")
    if not run_id.strip() or files_per_batch < 1 or tolerance < timedelta(0):
        raise ValueError("there must be a run id, a file per batch at least, and no negative tolerance")
    lines = store.spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "events_*.json").load(source)
    lines = lines.select("value", F.col("_metadata.file_path").alias("_source_file"))

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(store, batch, batch_id, stream, run_id, tolerance)

    query = lines.writeStream.foreachBatch(land).option("checkpointLocation", f"{checkpoints.rstrip('/')}/{stream}").queryName(stream).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception as e:
        raise RuntimeError(f"the stream {stream} failed: {e}") from e
    return {"stream_name": stream, "batches": record_progress(store, query.recentProgress, stream)}
