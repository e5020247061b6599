"""Tables of Parquet parts under one root, with a log of versions.

    <root>/<layer>/<table>/parts/_part=<id>/[_within=<value>/]   data, written once and never changed
    <root>/<layer>/<table>/log/<version>.json                    the parts a version consists of

A write adds a part, then a version that names it, which takes its place in one rename: readers see the table before
or after, older versions can still be read, and a part that no version names is as if it had never been. One writer a table is assumed; a
second one is refused if it took the next version's number first.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import Table

_NAME = re.compile(r"[A-Za-z0-9_]+")
#: Most values of ``within`` looked up one by one; a write that touches more reads the whole table.
TOUCHED = 1_000


def safe(name: str) -> str:
    """The name itself; anything but letters, digits and underscores is refused."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"unsafe identifier {name!r}")
    return name


class Files:
    """The few file operations that the log needs, on whatever file system the root is on."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def exists(self, path: str) -> bool:
        files, where = self.at(path)
        return files.exists(where)

    def names(self, path: str) -> list[str]:
        files, where = self.at(path)
        return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []

    def text(self, path: str) -> str:
        files, where = self.at(path)
        stream = files.open(where)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str, overwrite: bool = False) -> None:
        """The whole file or nothing: written under another name first."""
        files, where = self.at(path)
        draft = where.suffix(f".{uuid.uuid4().hex}")
        stream = files.create(draft)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if overwrite:
            files.delete(where, False)
        if files.exists(where) or not files.rename(draft, where):
            files.delete(draft, False)
            raise FileExistsError(path)

    def delete(self, path: str) -> None:
        files, where = self.at(path)
        files.delete(where, True)


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{Table(safe(layer), safe(name)).path}"

    # The log.

    def versions(self, layer: str, name: str) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.path(layer, name)}/log") if re.fullmatch(r"\d+\.json", n)]

    def version(self, layer: str, name: str) -> int:
        """The current version's number; 0 for a table that isn't there."""
        return max(self.versions(layer, name), default=0)

    def _log(self, layer: str, name: str, version: int | None = None) -> dict:
        """Parts (with their labels) and columns of a version."""
        version = self.version(layer, name) if version is None else version
        if not version:
            raise FileNotFoundError(f"there is no table {layer}.{name}")
        return json.loads(self.files.text(f"{self.path(layer, name)}/log/{version:012d}.json"))

    def _commit(self, layer: str, name: str, log: dict, after: int) -> None:
        self.files.write(f"{self.path(layer, name)}/log/{after + 1:012d}.json", json.dumps(log))

    def exists(self, layer: str, name: str) -> bool:
        return self.version(layer, name) > 0

    # Reading.

    def _parts(self, layer: str, name: str, log: dict, ids: list[str]) -> DataFrame:
        kind = StructType.fromJson(json.loads(log["columns"]))
        extra = "_part string" + ", _within string" * log["within"]
        rows = self.spark.read.schema(StructType([*kind, *StructType.fromDDL(extra)])).parquet(f"{self.path(layer, name)}/parts")
        return rows.where(F.col("_part").isin(ids)).drop("_part")

    def read(self, layer: str, name: str, version: int | None = None) -> DataFrame:
        """The table as it is, or as it was in a version."""
        log = self._log(layer, name, version)
        return self._parts(layer, name, log, list(log["parts"])).drop("_within")

    def labelled(self, layer: str, name: str, label: str) -> DataFrame | None:
        """The parts with a label; None if there are none."""
        if not self.exists(layer, name):
            return None
        log = self._log(layer, name)
        ids = [p for p, known in log["parts"].items() if known == label]
        return self._parts(layer, name, log, ids).drop("_within") if ids else None

    # Writing.

    def _write(self, rows: DataFrame, layer: str, name: str, label: str | None, keep, within: Column | None = None) -> None:
        """Add a part of ``rows``; of the parts so far those stay whose label ``keep`` accepts."""
        after = self.version(layer, name)
        log = self._log(layer, name) if after else {"parts": {}, "within": within is not None}
        part, columns = uuid.uuid4().hex, rows.schema.json()
        out = rows.withColumn("_within", within) if log["within"] else rows
        writer = out.write.partitionBy("_within") if log["within"] else out.write
        writer.parquet(f"{self.path(layer, name)}/parts/_part={part}")
        parts = {p: known for p, known in log["parts"].items() if keep(known)} | {part: label}
        # Columns of older parts stay readable: a version's columns are those of its last write that has all of them.
        if log["parts"] and len(json.loads(log["columns"])["fields"]) > len(rows.columns) and len(parts) > 1:
            columns = log["columns"]
        self._commit(layer, name, {"parts": parts, "columns": columns, "within": log["within"]}, after)

    def create(self, layer: str, name: str, like: DataFrame) -> None:
        """An empty table if there is none."""
        if not self.exists(layer, name):
            self._write(like.limit(0), layer, name, None, lambda _: True)

    def append(self, rows: DataFrame, layer: str, name: str, label: str | None = None) -> None:
        self._write(rows, layer, name, label, lambda _: True)

    def insert_only(self, rows: DataFrame, layer: str, name: str, keys: list[str], label: str | None = None, within: Column | None = None) -> None:
        """Append the rows whose keys the table doesn't have; matched rows stay as they are, and of rows that repeat a key one is taken. A null key matches nothing.

        Rows of equal keys have equal ``within``; the table is laid out by it, and only the values that the rows touch are read.
        """
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        rows = rows.where(known).dropDuplicates(keys).unionByName(rows.where(~known))
        if self.exists(layer, name):
            log = self._log(layer, name)
            old = self._parts(layer, name, log, list(log["parts"]))
            if within is not None and log["within"]:
                touched = [r[0] for r in rows.select(within).distinct().limit(TOUCHED + 1).collect()]
                old = old.where(F.col("_within").isin(touched)) if len(touched) <= TOUCHED else old
            rows = rows.join(old.select(*keys), keys, "left_anti").select(rows.columns)
        self._write(rows, layer, name, label, lambda _: True, within)

    def update_only(self, rows: DataFrame, layer: str, name: str, keys: list[str]) -> None:
        """New values, nulls too, for the rows of a small table that match; unmatched new rows are ignored."""
        self.replace(updated(self.read(layer, name), rows, keys), layer, name)

    def replace(self, rows: DataFrame, layer: str, name: str) -> None:
        """A whole new table."""
        self._write(rows, layer, name, None, lambda _: False)

    def replace_snapshot(self, rows: DataFrame, layer: str, name: str, column: str, value: datetime | str) -> None:
        """Replace one snapshot; others stay. An empty result clears it."""
        label = f"{safe(column)}={value.isoformat() if isinstance(value, datetime) else safe(value)}"
        self._write(rows, layer, name, label, lambda known: known != label)

    def replace_range(self, rows: DataFrame, layer: str, name: str, column: str, before: datetime, origin: str) -> None:
        """Replace the rows of one origin whose ``column`` is before an instant; its later rows and all others stay."""
        label = f"origin={safe(origin)}"
        old = self.labelled(layer, name, label)
        if old is not None:
            rows = rows.unionByName(old.where(F.coalesce(F.col(column) >= F.lit(before), F.lit(True))))
        self._write(rows, layer, name, label, lambda known: known != label)

    def compact(self, layer: str, name: str) -> None:
        """One part in place of many without a label, as streams leave them; nothing changes for readers."""
        after, log = self.version(layer, name), self._log(layer, name)
        plain = [p for p, label in log["parts"].items() if label is None]
        if len(plain) > 1:
            part, rows = uuid.uuid4().hex, self._parts(layer, name, log, plain)
            (rows.write.partitionBy("_within") if log["within"] else rows.write).parquet(f"{self.path(layer, name)}/parts/_part={part}")
            self._commit(layer, name, log | {"parts": {p: x for p, x in log["parts"].items() if x is not None} | {part: None}}, after)

    def vacuum(self, layer: str, name: str, keep: int = 1) -> list[str]:
        """Delete the versions before the last ``keep`` and the parts that none of these names; the deleted parts."""
        versions, folder = self.versions(layer, name), self.path(layer, name)
        live = {p for v in versions[-keep:] for p in self._log(layer, name, v)["parts"]}
        for v in versions[:-keep]:
            self.files.delete(f"{folder}/log/{v:012d}.json")
        gone = [n for n in self.files.names(f"{folder}/parts") if n.startswith("_part=") and n[6:] not in live]
        for n in gone:
            self.files.delete(f"{folder}/parts/{n}")
        return gone


#: The scratch folder of each application without a shared one.
_own: dict[str, str] = {}


def scratch_store(spark: SparkSession) -> Store:
    """A new, empty store in the folder that all executors share (``spark.checkpoint.dir``); without one, in a temporary folder if the master is local."""
    shared, app = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="tidewell-")
        shared = _own[app]
    return Store(spark, f"{shared.rstrip('/')}/tidewell/store-{uuid.uuid4().hex}")


def updated(old: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the values of the rows whose keys match."""
    values = [c for c in rows.columns if c not in keys]
    new = rows.select(*keys, F.lit(True).alias("_match"), *[F.col(c).alias(f"_new_{c}") for c in values])
    joined = old.join(new, keys, "left")
    return joined.select(*[F.when(F.col("_match"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in old.columns])
