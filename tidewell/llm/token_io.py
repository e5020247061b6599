"""Token ids of documents in binary shards.

A shard file holds one zstandard frame per document, all compressed with one shared
dictionary that was trained on serialised id arrays, and an index for reading any
short document alone.

File format (little-endian), version 1::

    frames                        one zstandard frame per document
    dictionary                    the shared dictionary's bytes
    index                         per document: doc_id int64, frame offset uint64, frame bytes uint32, ids uint32, flags uint32
    footer                        index offset uint64, dictionary offset uint64, documents uint64, ids uint64,
                                  SHA-256 of the dictionary (32 bytes), magic b"TWTOKEN1"

Flag 1: ids are stored as uint32 instead of uint16. Flag 2: the doc_id is null.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, gathered, gathered_runs, pa_schema, remembered, shared_dir, slices, small_batches, utf8

MAGIC = b"TWTOKEN1"
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("bytes", "<u4"), ("ids", "<u4"), ("flags", "<u4")])
_FOOT = np.dtype([("index", "<u8"), ("dictionary", "<u8"), ("documents", "<u8"), ("ids", "<u8"), ("hash", "S32")])
_FOOT_BYTES = 64 + len(MAGIC)
#: Bytes of text that a shard should hold about.
SHARD_BYTES = 64 << 20
#: Most ranges of rows dealt out; beyond, a task writes several shards.
RANGES = 20_000
#: Bytes of text encoded at once.
TEXT_BYTES = 8 << 20
#: Documents the dictionary is trained on at most, and its size.
SAMPLE, DICTIONARY = 2_000, 64 << 10
# Pieces of ASCII signs, digits and letters and Latin-1 letters, which have one lower case each and nothing to compose with; not the
# apostrophe, which may start a contraction.
_PLAIN = "^[!-&(-~À-ÖØ-öø-ÿ]+$"
_END = "</w>"
#: Runs given to the library as one text; it slows down on longer ones.
BLOCK = 300


def _kinds() -> np.ndarray:
    """Of each Latin-1 code point: 0 space, 1 letter, 2 digit, 3 sign."""
    table = np.full(256, 3, np.int8)
    table[32], table[48:58] = 0, 2
    table[[c for c in range(256) if chr(c).isalpha()]] = 1
    return table


_KINDS = _kinds()


class Encoder:
    """Encodes texts by their white-space separated pieces, each distinct piece of a slice once.

    That is exact for tokenizers that drop white space, normalise no character across it and split at it: no token spans it, so a
    text's ids are its pieces' ids in order. ``word_bpe`` tokenizers also lower-case, split into runs of letters, single digits and runs of signs, and
    end each with a token of its own; plain pieces are therefore encoded together and told apart by their number of ends. Others (an
    apostrophe, special tokens, letters beyond Latin-1) go one by one. ``whole`` encodes texts as they are, for other tokenizers.
    """

    def __init__(self, path: str, end: int | None, whole: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence

        self.tokenizer, self.whole, self.end = Tokenizer.from_file(path), whole, end
        self.bare = Tokenizer.from_file(path)  # for runs that are normal already
        self.bare.normalizer = Sequence([])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(_END)]] = True

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain pieces end to end, and each one's number of ids; each distinct run is encoded once."""
        data = np.frombuffer(" ".join(pieces).lower().encode("latin-1"), np.uint8)
        kind = _KINDS[data]
        starts = kind > 0
        starts[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        runs = np.add.reduceat(starts, np.concatenate([[0], np.flatnonzero(kind == 0)]), dtype=np.int64)
        data, begin = data[kind > 0], np.flatnonzero(starts[kind > 0])
        coded = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(data))), pa.py_buffer(data)]).dictionary_encode()
        words = coded.dictionary.to_pylist()
        blocks = [b" ".join(words[lo : lo + BLOCK]).decode("latin-1") for lo in range(0, len(words), BLOCK)]
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in self.bare.encode_batch_fast(blocks, add_special_tokens=False)])
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != len(words):
            raise ValueError("the tokenizer doesn't end every word with a token of its own; use whole=True")
        ids, at = gathered_runs(ids, np.diff(ends, prepend=-1), coded.indices.to_numpy())
        return ids, np.diff(at[np.concatenate([[0], np.cumsum(runs)])])

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any pieces; many make one encoding, which says what piece a token is of."""
        made = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        return np.array(made.ids, np.uint32), np.bincount(np.array(made.word_ids, np.int64), minlength=len(pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each with the end id, and where each text's begin; null counts as empty."""
        ends = 0 if self.end is None else 1
        if self.whole:
            rows = [self.tokenizer.encode(t or "", add_special_tokens=False).ids + [self.end] * ends for t in texts.to_pylist()]
            return np.array([i for r in rows for i in r], np.uint32), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        cut = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        edges = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.values.slice(edges[0], edges[-1] - edges[0]).dictionary_encode()
        pieces = coded.dictionary
        plain = pc.and_not(pc.match_substring_regex(pieces, _PLAIN), pc.match_substring(pieces, "<|")).to_numpy(zero_copy_only=False)
        sizes, flat = np.zeros(len(pieces), np.int64), []
        for some, solve in ((plain, self._together), (~plain, self._apart)):
            if some.any():
                ids, sizes[some] = solve(pieces.filter(pa.array(some)).to_pylist())
                flat.append(ids)
        place = np.empty(len(pieces), np.int64)
        place[np.argsort(~plain, kind="stable")] = np.arange(len(pieces))
        ids, at = gathered_runs(np.concatenate([np.zeros(0, np.uint32), *flat]), sizes[np.argsort(place)], place[coded.indices.to_numpy()])
        starts = at[edges - edges[0]]
        return (np.insert(ids, starts[1:], self.end) if ends else ids), starts + ends * np.arange(len(starts))


def _encoder(*key) -> Encoder:
    return remembered(("encoder", *key), lambda: Encoder(*key))


def _packed(ids: np.ndarray) -> tuple[bytes, int]:
    return (ids.astype("<u4").tobytes(), 1) if len(ids) and int(ids.max()) > 0xFFFF else (ids.astype("<u2").tobytes(), 0)


def train_dictionary(docs: DataFrame, path: str, end: int | None, whole: bool = False, sample: int = SAMPLE) -> bytes:
    """A zstandard dictionary from at most ``sample`` documents' packed ids (each at most 64 kB of text); empty if there are too few."""
    picked = docs.select("doc_id").where("doc_id is not null").withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(sample)
    rows = docs.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi").where(F.length("text") < 1 << 16).select("doc_id", "text")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(sample)

    def run(batch):
        ids, at = _encoder(path, end, whole).encode(batch.column("text"))
        return {"doc_id": batch.column("doc_id"), "ids": [_packed(ids[a:b])[0] for a, b in zip(at, at[1:], strict=False)]}

    samples = arrow_map(rows, run, "doc_id long, ids binary", fresh=False).toArrow().sort_by([("doc_id", "ascending"), ("ids", "ascending")]).column("ids").to_pylist()
    samples = [x for x in samples if len(x) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:  # too little to learn from
        return b""


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class ShardWriter:
    """Writes one shard under a name of its own attempt; a retried task leaves no half file behind under a listed name."""

    def __init__(self, uri: str, dictionary: bytes):
        self.fs, self.path = _opened(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out, self.dictionary, self.rows, self.at = self.fs.open_output_stream(self.path), dictionary, [], 0

    def add(self, doc_id: int | None, frame: bytes, ids: int, wide: int) -> None:
        self.out.write(frame)
        self.rows.append((doc_id or 0, self.at, len(frame), ids, wide | 2 * (doc_id is None)))
        self.at += len(frame)

    def close(self) -> tuple[int, int]:
        index = np.array(self.rows, INDEX)
        total = int(index["ids"].sum(dtype=np.int64))
        self.out.write(self.dictionary)
        self.out.write(index.tobytes())
        dictionary_at = self.at
        foot = np.array([(dictionary_at + len(self.dictionary), dictionary_at, len(index), total, b"")], _FOOT).tobytes()[:32]
        self.out.write(foot + hashlib.sha256(self.dictionary).digest() + MAGIC)
        self.out.close()
        return len(index), total


class ShardReader:
    """Random access to a shard's documents; checks the magic and the dictionary's hash."""

    def __init__(self, uri: str):
        system, path = _opened(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        foot = self.file.read_at(_FOOT_BYTES, size - _FOOT_BYTES)
        if foot[-8:] != MAGIC:
            raise ValueError(f"{uri} isn't a token shard")
        at, dictionary_at, n, self.ids = np.frombuffer(foot[:32], "<u8").tolist()
        dictionary = self.file.read_at(at - dictionary_at, dictionary_at)
        if hashlib.sha256(dictionary).digest() != foot[32:64]:
            raise ValueError(f"{uri}: the dictionary doesn't have its hash")
        self.index = np.frombuffer(self.file.read_at(n * INDEX.itemsize, at), INDEX)
        self.decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()

    def read(self, i: int) -> np.ndarray:
        row = self.index[i]
        return self._ids(self.file.read_at(int(row["bytes"]), int(row["offset"])), row)

    def _ids(self, frame: bytes, row) -> np.ndarray:
        return np.frombuffer(self.decoder.decompress(frame), "<u4" if row["flags"] & 1 else "<u2").astype("<u4")

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for i, row in enumerate(self.index):
            yield None if row["flags"] & 2 else int(row["doc_id"]), self.read(i)

    def close(self) -> None:
        self.file.close()


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, end: int | None = 1, whole: bool = False) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write shards under ``path`` in ascending doc_id order.

    Returns the manifest, also written under ``path``: shard, file, documents, ids, base (ids of all shards before). Null texts count
    as empty, null doc_ids come first; repeated rows are all written, rows of one doc_id in the order of their text's hash.
    Rows are dealt to ranges of doc_id and hash, so that no id's rows need to fit in one; a task sorts its range, encodes it and goes on to a new
    shard after SHARD_BYTES of text. What an executor loses is made again from the texts under new names; the manifest lists finished shards only.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(docs, tokenizer, end, whole)
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    ranges = int(min(1 + size // SHARD_BYTES, RANGES))
    sent = spark.sparkContext.broadcast(dictionary)
    small_batches(spark)
    ddl = "doc_id long, th long, part long, file string, documents long, ids long"
    listed = pa_schema(spark, ddl)

    def written(batches):
        encoder = _encoder(tokenizer, end, whole)
        shared = zstandard.ZstdCompressionDict(sent.value) if sent.value else None
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=False)
        writer, part, held = None, 0, 0

        def done():
            n, total = writer.close()
            return pa.RecordBatch.from_pydict({"doc_id": [first[0]], "th": [first[1]], "part": [part], "file": [name], "documents": [n], "ids": [total]}, schema=listed)

        for rows in gathered(batches, TEXT_BYTES):
            for lo, hi in slices(utf8(rows.column("text"))[0], TEXT_BYTES):
                texts, doc_ids = rows.column("text").slice(lo, hi - lo), rows.column("doc_id").slice(lo, hi - lo).to_pylist()
                if writer is None:
                    first, name = (doc_ids[0], rows.column("th")[lo].as_py()), f"{path}/shard-{uuid.uuid4().hex}.tok"
                    writer, held = ShardWriter(name, sent.value), 0
                ids, at = encoder.encode(texts)
                for doc_id, a, b in zip(doc_ids, at[:-1].tolist(), at[1:].tolist(), strict=True):
                    packed, wide = _packed(ids[a:b])
                    writer.add(doc_id, squeeze.compress(packed), b - a, wide)
                held += texts.nbytes
                if held >= SHARD_BYTES:
                    yield done()
                    writer, part = None, part + 1
        if writer:
            yield done()

    rows = docs.withColumn("th", F.xxhash64("text")).repartitionByRange(ranges, "doc_id", "th").sortWithinPartitions("doc_id", "th")
    manifest = f"{path}/manifest"
    rows.mapInArrow(written, ddl).write.parquet(manifest)
    # One row a shard: few enough for one task.
    order = Window.orderBy("doc_id", "th", "part")
    before = F.coalesce(F.sum("ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return spark.read.schema(ddl).parquet(manifest).select((F.row_number().over(order) - 1).alias("shard"), "file", "documents", "ids", before.alias("base"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids of every document, from the files."""
    return _from_files(manifest, "doc_id long, start long, n_tokens long, ids array<long>", lambda ids: ids.astype(np.int64))


def read_digests(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    import zlib

    return _from_files(manifest, "doc_id long, start long, n_tokens long, ids_crc32 long", lambda ids: zlib.crc32(ids.tobytes()))


def _from_files(manifest: DataFrame, ddl: str, last) -> DataFrame:
    kind = pa_schema(manifest.sparkSession, ddl)
    shards = max(1, manifest.count())

    def run(batches):
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                reader, rows = ShardReader(file), []
                for doc_id, ids in reader:
                    rows.append((doc_id, start, len(ids), last(ids)))
                    start += len(ids)
                    if len(rows) == 2048:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)
                reader.close()

    return manifest.repartition(min(shards, 10_000)).mapInArrow(run, ddl)


def token_folder(spark: SparkSession) -> str:
    """A new folder for shards in the shared folder."""
    return f"{shared_dir(spark)}/tidewell/tokens-{uuid.uuid4().hex}"
