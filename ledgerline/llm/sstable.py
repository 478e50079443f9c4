"""Token ids in sorted-string-table shards.

A shard holds entries in ascending key order.  A key is the document's identifier in an order-preserving binary form
(null first) and a running number that keeps repeated identifiers apart; a value is the document's ids, little-endian
unsigned 32-bit.  Layout::

    blocks   each: zstd of (entries, restart offsets (u32 each), their number (u32)), length before (u32), crc32 (u32)
             entry: varint shared, varint unshared, varint value length, key suffix, value
    bloom    bits of a Bloom filter over identifiers
    index    per block: u16 length of its first key, the key, u64 offset, u32 length, u64 ids before the block
    footer   u64 x 7 (bloom offset, bloom length, index offset, index length, hashes, entries, ids), magic

Shards are ranges of identifiers, so the shard of an identifier, its block and its restart point are all found by
binary search.  A writer streams block after block and moves the finished file into place under a name of its own, so
a task that runs again, or twice, never leaves half a shard in the manifest.  A shard is closed at ``SHARD_BYTES`` or
``SHARD_ENTRIES``, so neither a file nor what its writer and readers hold grows with the data; the number of tasks
follows the size of the input as the planner knows it.

Edge cases: a null text holds the end id alone.  An empty table has no shard.  Repeated identifiers are all kept, in
the order of the text's hash; they may go on in the next shard.  A document larger than a block has a block of its own.
Extra columns play no part.
"""

from __future__ import annotations

import bisect
import re
import struct
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ENTRY_BYTES, Memo, documents, scratch_path, short_batches
from .token_counts import by_bytes, gather, tokenizer

MAGIC = b"LLSST\x00\x00\x01"
FOOTER = struct.Struct("<7Q8s")
BLOCK_BYTES = 1 << 16
RESTART = 16
BLOOM_BITS, BLOOM_HASHES = 10, 7
#: Where a shard is closed.
SHARD_BYTES, SHARD_ENTRIES = 256 << 20, 2_000_000
#: Input, as the planner sees it, that one task writes.
TASK_BYTES = 128 << 20
#: Bytes of words and ids that a worker remembers, and the longest word of them in characters.
MEMO_BYTES, LONGEST_KEPT = 192 << 20, 256
#: Bytes of text that are split at once.
SLICE_BYTES = 8 << 20
END_ID = 1
_ZSTD = pa.Codec("zstd", compression_level=1)

_MARKS = r"([a-z])([.,;:!?*#$%&])"
_memos: dict[str, Memo] = {}


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and host, as Spark itself would resolve it: a bare path lies on its default file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it."""
    if "://" in path or path.startswith("file:"):
        path = re.sub("^s3[an]:", "s3:", path)
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return fs.LocalFileSystem(), path


# Keys ----------------------------------------------------------------------------------------------------------------


def identifier_key(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))


def key_identifier(key: bytes) -> int | None:
    return None if key[:1] == b"\0" else struct.unpack(">Q", key[1:9])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(b: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        x = b[at]
        n |= (x & 127) << shift
        at += 1
        if x < 128:
            return n, at
        shift += 7


def _probes(name: bytes, hashes: int, bits: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(name)
    a, b = h & (1 << 64) - 1, h >> 64 | 1
    return [(a + i * b) % bits for i in range(hashes)]


# Files ---------------------------------------------------------------------------------------------------------------


class ShardWriter:
    """Writes one shard; ``add`` takes entries in ascending order of identifier."""

    def __init__(self, folder: str, name: str):
        self.fs, at = file_system(folder)
        self.fs.create_dir(at, recursive=True)
        self.temp, self.path = f"{at}/_{name}.tmp", f"{at}/{name}.sst"
        self.uri = f"{folder}/{name}.sst"
        self.out = self.fs.open_output_stream(self.temp)
        self.offset = self.entries = self.ids = self.block_ids = 0
        self.index: list[tuple[bytes, int, int, int]] = []
        self.names: list[bytes] = []
        self.first = self.last = b""
        self._open()

    def _open(self) -> None:
        self.parts: list[bytes] = []
        self.size, self.inside, self.restarts, self.block_ids = 0, 0, [], self.ids

    def add(self, doc_id: int | None, value: bytes) -> None:
        name = identifier_key(doc_id)
        key = name + struct.pack(">Q", self.entries)
        if self.inside % RESTART == 0:
            shared = 0
            self.restarts.append(self.size)
        else:
            shared = next((i for i, (x, y) in enumerate(zip(key, self.last, strict=False)) if x != y), min(len(key), len(self.last)))
        if not self.inside:
            self.first = key
        entry = _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.parts.append(entry)
        self.size += len(entry)
        self.last, self.inside = key, self.inside + 1
        self.entries += 1
        self.ids += len(value) // 4
        if not self.names or self.names[-1] != name:
            self.names.append(name)
        if self.size >= BLOCK_BYTES:
            self._flush()

    def _write(self, b: bytes) -> None:
        self.out.write(b)
        self.offset += len(b)

    def _flush(self) -> None:
        if self.inside:
            body = b"".join(self.parts) + struct.pack(f"<{len(self.restarts)}II", *self.restarts, len(self.restarts))
            body = _ZSTD.compress(body, asbytes=True) + struct.pack("<I", len(body))
            body += struct.pack("<I", zlib.crc32(body))
            self.index.append((self.first, self.offset, len(body), self.block_ids))
            self._write(body)
        self._open()

    def close(self) -> None:
        self._flush()
        bits = max(64, len(self.names) * BLOOM_BITS)
        bloom = bytearray(-(-bits // 8))
        for name in self.names:
            for p in _probes(name, BLOOM_HASHES, len(bloom) * 8):
                bloom[p >> 3] |= 1 << (p & 7)
        bloom_at = self.offset
        self._write(bytes(bloom))
        index_at = self.offset
        self._write(b"".join(struct.pack("<H", len(k)) + k + struct.pack("<QIQ", at, n, ids) for k, at, n, ids in self.index))
        self._write(FOOTER.pack(bloom_at, len(bloom), index_at, self.offset - index_at, BLOOM_HASHES, self.entries, self.ids, MAGIC))
        self.out.close()
        self.fs.move(self.temp, self.path)


class Shard:
    """Reads one shard: ``get`` looks identifiers up, ``scan`` streams the entries."""

    def __init__(self, path: str):
        self.fs, at = file_system(path)
        self.file = self.fs.open_input_file(at)
        size = self.file.size()
        *numbers, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no shard")
        bloom_at, bloom_n, index_at, index_n, self.hashes, self.entries, self.ids = numbers
        self.bloom = self.file.read_at(bloom_n, bloom_at)
        raw, at, self.index = self.file.read_at(index_n, index_at), 0, []
        while at < len(raw):
            n = struct.unpack_from("<H", raw, at)[0]
            key = raw[at + 2 : at + 2 + n]
            self.index.append((key, *struct.unpack_from("<QIQ", raw, at + 2 + n)))
            at += 2 + n + 20
        self.firsts = [x[0] for x in self.index]

    def may_hold(self, doc_id: int | None) -> bool:
        return all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(identifier_key(doc_id), self.hashes, len(self.bloom) * 8))

    def _block(self, i: int) -> tuple[bytes, list[int]]:
        _, at, n, _ = self.index[i]
        raw = self.file.read_at(n, at)
        if zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("a block is damaged")
        raw = _ZSTD.decompress(raw[:-8], struct.unpack("<I", raw[-8:-4])[0], asbytes=True)
        count = struct.unpack("<I", raw[-4:])[0]
        return raw[: -4 - 4 * count], list(struct.unpack_from(f"<{count}I", raw, len(raw) - 4 - 4 * count))

    @staticmethod
    def _entries(body: bytes, at: int):
        key = b""
        while at < len(body):
            shared, at = _read_varint(body, at)
            own, at = _read_varint(body, at)
            n, at = _read_varint(body, at)
            key = key[:shared] + body[at : at + own]
            yield key, body[at + own : at + own + n]
            at += own + n

    def scan(self):
        """(doc_id, ids before it in the shard, value) of every entry, in order."""
        for i, (_, _, _, before) in enumerate(self.index):
            for key, value in self._entries(self._block(i)[0], 0):
                yield key_identifier(key), before, value
                before += len(value) // 4

    def get(self, doc_id: int | None) -> list[bytes]:
        """The values kept for an identifier (several if it repeats), by Bloom filter and binary search."""
        name, out = identifier_key(doc_id), []
        if not self.may_hold(doc_id):
            return out
        for i in range(max(0, bisect.bisect_left(self.firsts, name) - 1), len(self.index)):
            if self.firsts[i] > name + b"\xff" * 8:
                break
            body, restarts = self._block(i)
            lo = max(0, bisect.bisect_left(restarts, name, key=lambda at: next(self._entries(body, at))[0]) - 1)
            for key, value in self._entries(body, restarts[lo]):
                if key[:-8] == name:
                    out.append(value)
                elif key > name + b"\xff" * 8:
                    break
        return out


# Encoding ------------------------------------------------------------------------------------------------------------


def encode(path: str, texts: pa.Array) -> list[bytes]:
    """Ids of whole texts (null: none) as little-endian u32.

    The word vocabulary's normaliser lowers letters, and its pre-tokenizer drops white space and splits there, and
    between an ASCII letter and the marks of ``_MARKS``.  So words are split off in Arrow, each distinct one is encoded
    once and remembered, and the ids of a batch are gathered by word number.  A text with the start of a special token
    goes to the library whole, since lowering could make one.
    """
    t, memo = tokenizer(path), _memos.setdefault(path, Memo(MEMO_BYTES))
    texts = pc.fill_null(texts, "")
    special = pc.match_substring(texts, "<|")
    out: list[bytes] = []
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + SLICE_BYTES)))
        own = pc.if_else(special.slice(at, end - at), "", texts.slice(at, end - at))
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(own), pattern=_MARKS, replacement=r"\1 \2"))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        memo.room()
        for some in by_bytes([x for x in distinct if x not in memo]):
            values = [struct.pack(f"<{len(own)}I", *own) for own in (e.ids for e in t.encode_batch_fast(some, add_special_tokens=False))]
            memo.learn(some, values, 2 * sum(map(len, some)) + sum(map(len, values)))
        out += gather(words, coded, list(map(memo.__getitem__, distinct)))
        for x in [x for x in distinct if len(x) > LONGEST_KEPT]:
            memo.size -= 2 * len(x) + len(memo.pop(x)) + ENTRY_BYTES
        at = end
    for i in np.nonzero(special.to_numpy(zero_copy_only=False))[0]:
        e = t.encode(texts[int(i)].as_py(), add_special_tokens=False)
        out[i] = struct.pack(f"<{len(e.ids)}I", *e.ids)
    return out


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """Writes the ids of ``docs`` (doc_id long, text string) as shards in ``folder``, ranges of doc_id; the manifest."""
    spark = docs.sparkSession
    short_batches(spark)
    end = struct.pack("<I", end_id)

    schema = pa.schema([("path", pa.string()), ("least", pa.int64()), ("most", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()), ("part", pa.int64())])
    folder = qualified(spark, folder)

    def run(batches):
        out, least, part = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            for doc_id, value in zip(batch.column(0).to_pylist(), encode(path, batch.column(1)), strict=True):
                if out and (out.offset + out.size >= shard_bytes or out.entries >= shard_entries):
                    out.close()
                    yield pa.RecordBatch.from_pylist([{"path": out.uri, "least": least, "most": most, "docs": out.entries, "ids": out.ids, "part": part}], schema=schema)
                    out, part = None, part + 1
                if not out:
                    out, least = ShardWriter(folder, uuid.uuid4().hex), doc_id
                out.add(doc_id, value + end)
                most = doc_id
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": out.uri, "least": least, "most": most, "docs": out.entries, "ids": out.ids, "part": part}], schema=schema)

    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # A plan of unknown size counts as boundless; then the session's setting has to do.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES if size < 1 << 60 else 0)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    ranged = keyed.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "h").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h").select("doc_id", "text")
    manifest = ranged.mapInArrow(run, "path string, least long, most long, docs long, ids long, part long").withColumn("task", F.spark_partition_id())
    rows = manifest.collect()  # one row a shard; shards that no row names belong to attempts that were lost
    rows.sort(key=lambda r: (r["task"], r["part"]))  # ranges in order of tasks, shards in order within a task
    start, out = 0, []
    for i, r in enumerate(rows):
        out.append((i, r["path"], r["least"], r["most"], r["docs"], r["ids"], start))
        start += r["ids"]
    return spark.createDataFrame(out, "shard int, path string, least long, most long, docs long, ids long, start long")


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every entry of the shards, as the files have them."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for doc_id, before, value in Shard(path).scan():
                    rows.append((doc_id, start + before, len(value) // 4, zlib.crc32(value)))
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

    n = max(1, manifest.count())
    return manifest.select("path", "start", "shard").repartitionByRange(n, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, manifest: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, value) for the identifiers in ``ids``: binary search in the manifest (a row a shard, sent to every task)
    picks the shards, their index the block."""
    rows = sorted((r["shard"], r["path"], identifier_key(r["least"]), identifier_key(r["most"])) for r in manifest.select("shard", "path", "least", "most").collect())
    shards = spark.sparkContext.broadcast(tuple([r[i] for r in rows] for i in (1, 2, 3)))

    def route(batches):
        paths, least, most = shards.value
        for batch in batches:
            out = []
            for doc_id in batch.column(0).to_pylist():
                key = identifier_key(doc_id)
                i = bisect.bisect_left(most, key)
                while i < len(paths) and least[i] <= key:  # a repeated identifier may go on in the next shard
                    out.append((paths[i], doc_id))
                    i += 1
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())], names=["path", "doc_id"])

    def run(batches):
        open_: dict[str, Shard] = {}
        for batch in batches:
            out = []
            for path, doc_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path not in open_:
                    open_.clear()
                    open_[path] = Shard(path)
                out += [(doc_id, v) for v in open_[path].get(doc_id)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], names=["doc_id", "value"])

    hit = ids.select("doc_id").distinct().mapInArrow(route, "path string, doc_id long")
    return hit.repartition("path").sortWithinPartitions("path").mapInArrow(run, "doc_id long, value binary")


def op3_token_shards(spark, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the shards."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return read_shards(write_shards(docs, scratch_path(spark, "ids"), public_tokenizers.path("word_bpe_49k.json")))
