"""Shared plumbing of the training-data operators: written intermediate tables,
size-checked broadcasts and vectorised text hashing over Arrow buffers."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows a side may have to be broadcast; larger sides join by shuffle.
BROADCAST_ROWS = 400_000
#: Bytes of text hashed at once; bounds the memory of a Python worker.
CHUNK = 1 << 20
#: Bytes of a row group in an intermediate table, which a task holds while it writes.
ROW_GROUP = 32 << 20
#: Most rows in an Arrow batch.
BATCH_ROWS = 1_000

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); where that is unset, a temporary one if the master is local, else an error."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="tidewell-")
    return _own_dirs[app]


class Scratch:
    """Intermediate tables in the shared folder: they cut lineage and outlive lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{shared_dir(self.spark)}/tidewell/{name}-{uuid.uuid4().hex}"
        # A marker file isn't needed: a failed write raises here.
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").option("parquet.block.size", ROW_GROUP).parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables no later plan reads."""
        for name in names:
            remove(self.spark, self.paths.pop(name))


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if the frame is proved to have at most ``rows`` rows (counted up to that bound)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def private(name: str) -> str:
    """A column name that no table has."""
    return f"_{name}_{uuid.uuid4().hex}"


def fold(key: Column, divisor: int) -> Column:
    """crc32 of a key as text, modulo ``divisor``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return ends, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of rows that together have at most ``limit`` bytes; a longer row comes alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def gathered(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``limit`` bytes in ``column``; empty ones go."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(column).nbytes
        if size >= limit:
            yield held[0] if len(held) == 1 else pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def gathered_runs(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat``, which have these sizes one after the other, in the order of the codes; and where each begins."""
    n = sizes[codes]
    at = np.concatenate([[0], np.cumsum(n)])
    step = ((np.cumsum(sizes) - sizes)[codes] - at[:-1]).astype(np.int32)  # a slice's ids are far fewer than 2 ** 31
    return flat[np.repeat(step, n) + np.arange(at[-1], dtype=np.int32)], at


_MUL = np.uint64(0x9E3779B97F4A7C15)
_P = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = CHUNK + 1
    up, down = np.full(n, _P, np.uint64), np.full(n, pow(_P, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@functools.cache
def _bytes_table(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    return mix((codes + np.uint64(1)) * _MUL)


@functools.cache
def _space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    return table


def hash_words(data: np.ndarray, starts: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and byte positions of the words (runs without ASCII white space) of ``data``.

    ``starts`` has the byte positions where texts begin, which no word crosses. Memory beyond
    8 bytes a word stays bounded: longer input is cut at white space, and a longer word is summed in pieces.
    """
    if len(data) > CHUNK:
        hashes, places, at = [], [], 0
        while at < len(data):
            end = min(at + CHUNK, len(data))
            if end < len(data):
                gaps = np.flatnonzero(_space()[data[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:
                    while end < len(data) and not len(gaps := np.flatnonzero(_space()[data[end : end + CHUNK]])):
                        end = min(end + CHUNK, len(data))
                    end += int(gaps[0]) if end < len(data) else 0
            piece = data[at:end]
            inside = starts[(starts >= at) & (starts < end)] - at
            if len(piece) > CHUNK:  # one word only
                h, p = _long_word(piece, lower)
            else:
                h, p = _hash_chunk(piece, inside, lower)
            hashes.append(h)
            places.append(p + at)
            at = end
        return np.concatenate(hashes), np.concatenate(places)
    return _hash_chunk(data, starts, lower)


def _hash_chunk(data, starts, lower):
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~_space()[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[starts[starts < len(data)]] |= word[starts[starts < len(data)]]
    begin = np.flatnonzero(first)
    last = word.copy()
    last[:-1] &= ~word[1:]
    cut = starts[(starts > 0) & (starts <= len(data))] - 1
    last[cut] |= word[cut]
    end = np.flatnonzero(last) + 1
    up, down = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_bytes_table(lower)[data] * up[: len(data)], out=sums[1:])
    raw = (sums[end] - sums[begin]) * down[begin]
    return mix(raw + (end - begin).astype(np.uint64) * _MUL), begin


def _long_word(data, lower):
    """One word longer than a chunk: the sums of its pieces, each scaled to its place."""
    total, scale = 0, 1
    up, _ = _powers()
    for at in range(0, len(data), CHUNK):
        piece = data[at : at + CHUNK]
        total += scale * int(np.sum(_bytes_table(lower)[piece] * up[: len(piece)], dtype=np.uint64))
        scale = scale * pow(_P, CHUNK, 1 << 64) % (1 << 64)
    raw = np.array([total % (1 << 64)], np.uint64)
    return mix(raw + np.array([len(data)], np.uint64) * _MUL), np.zeros(1, np.int64)


def batch_words(batch: pa.RecordBatch, column: str, lower: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each row: its number, its word hashes, their byte positions in it, and its bytes."""
    offsets, data = utf8(batch.column(column))
    for lo, hi in slices(offsets):
        base = offsets[lo]
        starts = offsets[lo : hi + 1] - base
        hashes, places = hash_words(data[base : offsets[hi]], starts[:-1], lower)
        edges = np.searchsorted(places, starts)
        for i in range(hi - lo):
            a, b = edges[i], edges[i + 1]
            yield lo + i, hashes[a:b], places[a:b] - starts[i], data[base + starts[i] : base + starts[i + 1]]


def small_batches(spark: SparkSession) -> None:
    """Bound the rows that travel to a Python worker at once, so that batches of long texts fit in memory on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


#: What a worker keeps between tasks: one operator's at a time.
_kept: dict[tuple, object] = {}


def remembered(key: tuple, make):
    """The object that the worker's last task made under this key, else a new one in its place."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Drop what other operators' tasks left in the worker, and give unused memory back."""
    _kept.clear()
    _powers.cache_clear()
    trim()


def trim() -> None:
    """Give the worker's unused memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def arrow_map(df: DataFrame, run, schema: str, fresh: bool = True) -> DataFrame:
    """``mapInArrow`` where ``run(batch)`` gives a dict of columns in the schema's order; ``fresh`` tasks use nothing that is remembered."""
    kind = pa_schema(df.sparkSession, schema)
    small_batches(df.sparkSession)

    def each(batches):
        if fresh:
            forget()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(run(batch), schema=kind)
        trim()

    return df.mapInArrow(each, schema)


def arrow_fold(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` where ``run(batches)`` reads all of a task's batches and gives one dict of columns."""
    kind = pa_schema(df.sparkSession, schema)
    small_batches(df.sparkSession)

    def all_(batches):
        forget()
        yield pa.RecordBatch.from_pydict(run(b for b in batches if b.num_rows), schema=kind)

    return df.mapInArrow(all_, schema)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl), prefers_large_types=False)
