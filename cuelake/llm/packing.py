"""Operator 4: variable-capacity best-fit packing of token ids.

A bin of length L costs ``BIN_COST + L + L * L / ATTENTION``: its set-up, its tokens with padding, and attention, which grows with
the square. Texts longer than the largest length are cut into full pieces and a rest. Within a shard the permitted lengths are
chosen jointly: every subset of them that can hold the longest piece is a plan; in a plan pieces go longest first into the
open bin they fill best, and where none fits, the size of least cost per token that what remains can fill is opened; at the
end every bin shrinks to the smallest permitted length that holds its contents. The plan of least total cost stays.

Shards have about ``SHARD_TOKENS`` tokens at any input size; pieces are dealt by a row number, so equal rows and the pieces of one long
text spread. Null and empty texts are one end token; repeated rows and null ids are packed like any other; ties go by id and
piece; an empty table gives no bin; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..shipping import materialize, ship_package
from .tokens import ByteLevelEncoder, loaded

LENGTHS = (512, 1024, 2048, 4096, 8192)
#: Tokens' worth of cost of any bin, beside its length.
BIN_COST = 64
#: Length at which attention costs as much as all else of a token.
ATTENTION = 65_536
SHARD_TOKENS = 6_000_000
END_ID = 0


def cost(length: int) -> float:
    return BIN_COST + length + length * length / ATTENTION


def best_fit(sizes: list[int], opened, lengths=LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Bin of each piece, its offset in the bin, and the length of each bin, where bins are opened at lengths in ``opened``."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    left = sum(sizes)
    bin_of, offset, used = [0] * len(sizes), [0] * len(sizes), []
    room: list[tuple[int, int]] = []  # (free tokens, bin), sorted
    for i in order:
        n = sizes[i]
        k = bisect_left(room, (n, -1))
        if k < len(room):
            free, b = room.pop(k)
        else:
            free = min((c for c in opened if c >= n), key=lambda c: (cost(c) / min(c, left), c))
            b = len(used)
            used.append(0)
        bin_of[i], offset[i] = b, used[b]
        used[b] += n
        left -= n
        if free > n:
            insort(room, (free - n, b))
    return bin_of, offset, [next(c for c in lengths if c >= u) for u in used]


def joint_fit(sizes: list[int], lengths=LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """The plan of least total cost over all subsets of the lengths; ties go to the smaller subset, then to the shorter lengths."""
    if not sizes:
        return [], [], []
    lengths, longest = sorted(lengths), max(sizes)
    plans = [p for k in range(1, len(lengths) + 1) for p in combinations(lengths, k) if p[-1] >= longest]
    return min((best_fit(sizes, p, lengths) for p in plans), key=lambda plan: sum(map(cost, plan[2])))


def pieces(docs: DataFrame, path: str, most: int) -> DataFrame:
    """(doc_id, piece, n_tokens, ids) of whole texts with the end token, cut after every ``most`` tokens; ids are little-endian bytes."""
    ship_package(docs.sparkSession)

    def run(batches):
        enc = loaded(ByteLevelEncoder, path)
        end = np.array([END_ID], dtype=enc.dtype).tobytes()
        step = most * enc.width
        for b in batches:
            for i in range(0, b.num_rows, 256):
                s = b.slice(i, 256)
                rows = [(d, k, v[at : at + step]) for d, t in zip(s.column(0).to_pylist(), s.column(1).to_pylist()) for v in (enc.encode_batch([t])[0] + end,) for k, at in enumerate(range(0, len(v), step))]
                d, k, v = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(k, pa.int32()), pa.array([len(x) // enc.width for x in v], pa.int64()), pa.array(v, pa.binary())], ["doc_id", "piece", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    return rows.mapInArrow(run, "doc_id long, piece int, n_tokens long, ids binary")


def pack(docs: DataFrame, path: str, lengths=LENGTHS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per bin: shard, bin, bin_length, n_tokens, and in the order of the bin doc_ids, pieces, starts, and all ids as bytes."""
    rows = materialize(pieces(docs, path, max(lengths)).withColumn("row", F.monotonically_increasing_id()), "pieces")
    shards = (rows.agg(F.sum("n_tokens")).first()[0] or 0) // shard_tokens + 1
    dealt = rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "doc_id", "piece", "n_tokens", "ids")

    def run(key, table):
        t = table.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets, size = joint_fit(t.column("n_tokens").to_pylist(), lengths)
        order = np.lexsort((offsets, bins))
        cuts = np.searchsorted(np.asarray(bins)[order], np.arange(len(size) + 1))
        t = t.take(pa.array(order))
        doc, piece, n, ids = (t.column(c).to_pylist() for c in ("doc_id", "piece", "n_tokens", "ids"))
        starts = np.asarray(offsets)[order].tolist()
        parts = [slice(a, z) for a, z in zip(cuts, cuts[1:])]
        each = lambda values: [values[p] for p in parts]
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()] * len(size), pa.int64()),
                "bin": pa.array(range(len(size)), pa.int64()),
                "bin_length": pa.array(size, pa.int64()),
                "n_tokens": pa.array(map(sum, each(n)), pa.int64()),
                "doc_ids": pa.array(each(doc), pa.list_(pa.int64())),
                "pieces": pa.array(each(piece), pa.list_(pa.int32())),
                "starts": pa.array(each(starts), pa.list_(pa.int64())),
                "ids": pa.array([b"".join(x) for x in each(ids)], pa.binary()),
            }
        )

    schema = "shard long, bin long, bin_length long, n_tokens long, doc_ids array<long>, pieces array<int>, starts array<long>, ids binary"
    return dealt.groupBy("shard").applyInArrow(run, schema)


def digests(bins: DataFrame) -> DataFrame:
    """The bins with an unsigned CRC-32 in place of their ids."""
    return bins.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
