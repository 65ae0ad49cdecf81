"""Operator 1: token ids in sorted-string-table shards.

File: data blocks, then a Bloom filter, the sparse block index and a fixed footer. A block holds entries
(shared key bytes, new key bytes, value) with a whole key every ``RESTART`` entries, zstd-compressed and
checksummed; the index holds each block's last key. Keys: one byte (0 null id, 1 else) and the id, big-endian with its
sign bit flipped, so byte order is id order. Values: token ids of 2 or 4 bytes.

Null texts count as empty; repeated ids are kept, ordered by text hash; null ids come first; an empty table gives no shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from ..shipping import scratch_path, ship_package
from .tokens import ByteLevelEncoder, loaded

MAGIC = b"CUESST01"
RESTART = 16
BLOCK_BYTES = 256 * 1024
BLOOM_BITS_PER_KEY, BLOOM_HASHES = 10, 7
_FOOTER = struct.Struct("<QQQQQQB8s")


def key_of(doc_id: int | None) -> bytes:
    return b"\x00" if doc_id is None else b"\x01" + struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return None if key == b"\x00" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(b: bytes, p: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        n |= (b[p] & 127) << shift
        p += 1
        if b[p - 1] < 128:
            return n, p
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    import xxhash

    h = xxhash.xxh128_intdigest(key)
    return [((h & (2**64 - 1)) + i * (h >> 64 | 1)) % bits for i in range(BLOOM_HASHES)]


class SstWriter:
    def __init__(self, out, width: int):
        import zstandard

        self.out, self.width, self.at, self.zip = out, width, 0, zstandard.ZstdCompressor(level=1)
        self.index: list[bytes] = []
        self.keys: list[bytes] = []
        self.tokens = self.rows = 0
        self._new()

    def _new(self):
        self.block, self.in_block, self.block_bytes, self.last = [], 0, 0, b""

    def add(self, key: bytes, value: bytes) -> None:
        if self.keys and key < self.keys[-1]:
            raise ValueError("keys must ascend")
        shared = 0
        if self.in_block % RESTART:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        head = _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:]
        self.block += [head, value]
        self.block_bytes += len(head) + len(value)
        self.in_block, self.last = self.in_block + 1, key
        self.keys.append(key)
        self.tokens += len(value) // self.width
        self.rows += 1
        if self.block_bytes >= BLOCK_BYTES:
            self._flush()

    def _put(self, raw: bytes) -> tuple[int, int]:
        body = self.zip.compress(raw)
        body += struct.pack("<I", zlib.crc32(body))
        self.out.write(body)
        at, self.at = self.at, self.at + len(body)
        return at, len(body)

    def _flush(self) -> None:
        if self.block:
            at, size = self._put(b"".join(self.block))
            self.index.append(_varint(len(self.last)) + self.last + _varint(at) + _varint(size))
            self._new()

    def close(self) -> None:
        self._flush()
        bits = max(64, BLOOM_BITS_PER_KEY * len(self.keys)) + 7 & ~7
        bloom = bytearray(bits // 8)
        for k in self.keys:
            for p in _probes(k, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        b, i = self._put(bytes(bloom)), self._put(b"".join(self.index))
        self.out.write(_FOOTER.pack(*b, *i, self.rows, self.tokens, self.width, MAGIC))


class SstReader:
    """Random access: Bloom filter, then binary search in the sparse index, then one block."""

    def __init__(self, source, size: int):
        self.f = source
        f = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if f[-1] != MAGIC:
            raise ValueError("not a table shard")
        self.rows, self.tokens, self.width = f[4], f[5], f[6]
        self.bloom = self._block(f[0], f[1])
        raw, p = self._block(f[2], f[3]), 0
        self.last, self.blocks = [], []
        while p < len(raw):
            n, p = _read_varint(raw, p)
            self.last.append(raw[p : p + n])
            at, p = _read_varint(raw, p + n)
            size, p = _read_varint(raw, p)
            self.blocks.append((at, size))

    def _at(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    def _block(self, at: int, n: int) -> bytes:
        import zstandard

        body = self._at(at, n)
        if zlib.crc32(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
            raise ValueError("damaged block")
        return zstandard.ZstdDecompressor().decompress(body[:-4])

    def entries(self, block: int):
        raw, p, key = self._block(*self.blocks[block]), 0, b""
        while p < len(raw):
            shared, p = _read_varint(raw, p)
            fresh, p = _read_varint(raw, p)
            n, p = _read_varint(raw, p)
            key = key[:shared] + raw[p : p + fresh]
            p += fresh
            yield key, raw[p : p + n]
            p += n

    def scan(self):
        for i in range(len(self.blocks)):
            yield from self.entries(i)

    def get(self, key: bytes) -> bytes | None:
        bits = len(self.bloom) * 8
        if any(not self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, bits)):
            return None
        i = bisect_left(self.last, key)
        return next((v for k, v in self.entries(i) if k == key), None) if i < len(self.blocks) else None


def filesystem(uri: str):
    """File system and path of a URI or plain path, by pyarrow."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int = 0) -> DataFrame:
    """Encode whole texts, append ``end_id``, write one shard per range of ids; returns the manifest.

    A retried task writes a new file name; only files in the manifest count.
    """
    ship_package(docs.sparkSession)

    def run(batches):
        enc = loaded(ByteLevelEncoder, path)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        out = writer = name = first = last = None
        for b in batches:
            for i in range(0, b.num_rows, 512):
                s = b.slice(i, 512)
                for doc, ids in zip(s.column(0).to_pylist(), enc.encode_batch(s.column(1).to_pylist())):
                    if writer is None:
                        name = f"{folder}/shard-{uuid.uuid4().hex}.sst"
                        fs, p = filesystem(name)
                        fs.create_dir(p.rsplit("/", 1)[0])
                        out = fs.open_output_stream(p)
                        writer, first = SstWriter(out, enc.width), key_of(doc)
                    last = key_of(doc)
                    writer.add(last, ids + end)
        if writer:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": name, "first_key": first, "last_key": last, "n_rows": writer.rows, "n_tokens": writer.tokens}])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "t")
    return rows.mapInArrow(run, "path string, first_key binary, last_key binary, n_rows long, n_tokens long")


def read_shards(spark, manifest: list) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files; ``manifest`` has one row per shard."""
    ship_package(spark)
    parts, base = [], 0
    for r in sorted(manifest, key=lambda r: (bytes(r["first_key"]), bytes(r["last_key"]))):
        parts.append((r["path"], base))
        base += r["n_tokens"]

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, p = filesystem(r["path"])
                with fs.open_input_file(p) as f:
                    sst, start, rows = SstReader(f, f.size()), r["base"], []
                    for k, v in sst.scan():
                        ids = np.frombuffer(v, dtype="<u2" if sst.width == 2 else "<u4")
                        rows.append({"doc_id": id_of(k), "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())})
                        start += len(ids)
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    files = spark.createDataFrame(parts, "path string, base long").repartition(max(1, len(parts)))
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def token_table(docs: DataFrame, path: str) -> DataFrame:
    spark = docs.sparkSession
    manifest = write_shards(docs, path, scratch_path(spark, "sst")).collect()  # one row per shard
    return read_shards(spark, manifest)
