"""CSV landing: all fields as text, content hashes, insert-only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.expr import content_hash
from .store import Store


@dataclass(frozen=True)
class Landed:
    source: str
    rows_read: int
    rows_written: int
    duplicate_rows: int


def read_csv(spark: SparkSession, entity: str, path: str, run_id: str) -> DataFrame:
    """Rows of a CSV file or folder with a header, with lineage and a hash of the business fields."""
    fields = schema.names(entity)
    rows = spark.read.schema(schema.raw(entity)).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return rows.select(*fields, F.current_timestamp().alias("_ingested_at"), F.col("_metadata.file_path").alias("_source_file"), F.lit(run_id).alias("_pipeline_run_id"), content_hash(fields).alias("_record_hash"))


def ingest(store: Store, entity: str, path: str, run_id: str) -> Landed:
    """Land a file once: rows that the table has, or the file repeats, are duplicates."""
    if entity not in schema.FIELDS or not run_id.strip():
        raise ValueError("unknown entity or empty run id")
    rows = read_csv(store.spark, entity, path, run_id)
    read = rows.count()
    before = store.read("bronze", entity).count() if store.exists("bronze", entity) else 0
    store.insert_only(rows.dropDuplicates(["_record_hash"]), "bronze", entity, ["_record_hash"])
    written = store.read("bronze", entity).count() - before
    return Landed(entity, read, written, read - written)
