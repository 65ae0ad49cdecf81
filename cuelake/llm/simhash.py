"""Operator 6: SimHash near-duplicates by pivot distance tables.

Each distinct fingerprint gets its Hamming distances to ``PIVOTS`` reference fingerprints once, a table of one byte each that it
carries along. Within 2 bits, no distance to a pivot differs by more than 2, so pairs with a larger coordinate difference are
discarded and survivors verified by exact distance. Distances to random pivots are alike for nearly all fingerprints (README has
figures), so a table alone cannot say who meets whom without comparing all: pairs meet where three of five bit blocks
agree (two differing bits spoil at most two blocks, so none is lost); a crowded meeting place is dealt again by blocks of its
free bits, where at most 2,048 can meet. Each place returns a spanning forest of its links. Components come from rounds of
smallest-neighbour hooking over fingerprints, each written, and are named by their smallest id at the end.

Null texts count as empty; texts without words have fingerprint zero, linked like any other; null ids sort last, a component
of them alone has none; repeated rows share a fingerprint; very long texts are counted in slices; extra columns are ignored;
an empty table gives no row.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..shipping import materialize, ship_package

PIVOTS = 32
RADIUS = 2
CROWDED = 512


def pivots() -> np.ndarray:
    return np.random.default_rng(64).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def fingerprint(text: str, shingle: int = 3) -> int:
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)))] or [b" ".join(words)]
    bits = np.zeros(64, dtype=np.int64)
    for i in range(0, len(grams), 32768):
        h = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams[i : i + 32768]), dtype=">u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(grams)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) with fp as a signed long."""
    ship_package(docs.sparkSession)

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t) for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, "doc_id long, fp long")


def _meeting_keys(bits: list[int]) -> list[int]:
    """Masks of the bits that agree: all choices of three of five blocks of the given bits."""
    n, at, blocks = len(bits), 0, []
    for i in range(5):
        size = n // 5 + (i < n % 5)
        blocks.append(sum(1 << b for b in bits[at : at + size]))
        at += size
    return [sum(c) for c in combinations(blocks, 3)]


def distance_tables(distinct: DataFrame) -> DataFrame:
    """``distinct`` (fp, label) with ``table``: the distances to all pivots, one byte each."""
    ship_package(distinct.sparkSession)

    def run(batches):
        at = pivots()
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            tables = np.bitwise_count(fps[:, None] ^ at).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([t.tobytes() for t in tables], pa.binary())], ["fp", "label", "table"])

    return distinct.select("fp", "label").mapInArrow(run, "fp long, label long, table binary")


def forest(fps: np.ndarray, table: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of links within RADIUS among distinct fingerprints: pivot filter, then verification."""
    n = len(fps)
    root, links = list(range(n)), []

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n - 1):
        near = np.flatnonzero(np.abs(table[i + 1 :] - table[i]).max(axis=1) <= RADIUS) + i + 1
        for j in near[np.bitwise_count(fps[near] ^ fps[i]) <= RADIUS]:
            a, b = find(i), find(int(j))
            if a != b:
                root[b] = a
                links.append((int(fps[i].view(np.int64)), int(fps[j].view(np.int64))))
    return links


def _masked(masks: list[int]):
    """Array of the values of ``fp`` under each mask."""
    return F.array(*[F.col("fp").bitwiseAND(F.lit(np.uint64(m).view(np.int64).item())) for m in masks])


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links that connect every two distinct fingerprints within RADIUS bits of each other. distinct: (fp, table)."""
    masks = _meeting_keys(list(range(64)))
    seats = distinct.select("fp", "table", F.posexplode(_masked(masks)).alias("k", "v"))
    size = seats.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    seats = materialize(seats.join(size, ["k", "v"]), "seats")
    inner = [np.array(_meeting_keys([b for b in range(64) if not m >> b & 1]), dtype=np.uint64).view(np.int64).tolist() for m in masks]
    again = F.element_at(F.lit(inner), F.col("k") + 1)
    crowded = seats.where(F.col("n") > CROWDED).withColumn("again", again).select("fp", "table", "k", "v", F.posexplode(F.transform("again", lambda m: F.col("fp").bitwiseAND(m))).alias("k2", "v2"))
    plain = seats.where(F.col("n") <= CROWDED).select("fp", "table", "k", "v", F.lit(-1).alias("k2"), F.lit(0).cast("long").alias("v2"))

    def run(_, t):
        fps, at = np.unique(t.column("fp").to_numpy().view(np.uint64), return_index=True)
        table = np.frombuffer(b"".join(t.column("table").take(pa.array(at)).to_pylist()), dtype=np.uint8).reshape(-1, PIVOTS).astype(np.int8)
        found = forest(fps, table)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return plain.unionByName(crowded).groupBy("k", "v", "k2", "v2").applyInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) of every end of an edge: smallest end reachable. Alternates hooking onto smallest neighbours and short-cuts."""
    e = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    touched = materialize(e, "edges")
    state = materialize(touched.groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("m")).select("fp", F.least("fp", "m").alias("root")), "roots")
    while True:
        near = touched.join(state, touched["b"] == state["fp"]).groupBy("a").agg(F.min("root").alias("m"))
        new = state.join(near, state["fp"] == near["a"]).select("fp", F.least("root", "m").alias("root"), F.col("root").alias("was"))
        # Short-cut: every holder of a root follows the smallest that any of them has found.
        jump = new.groupBy("was").agg(F.min("root").alias("to"))
        new = materialize(new.join(jump, "was").select("fp", F.least("root", "to").alias("root"), "was"), "roots")
        changed = new.where("root < was").limit(1).count()
        state = new.select("fp", "root")
        if not changed:
            return state


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every row."""
    fps = materialize(fingerprints(docs), "fingerprints")
    nodes = materialize(distance_tables(fps.groupBy("fp").agg(F.min("doc_id").alias("label"))), "distinct")
    root = components(materialize(links(nodes.select("fp", "table")), "links"))
    rooted = nodes.select("fp", "label").join(root, "fp", "left").select("fp", "label", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("label").alias("component_id"))
    label = materialize(rooted.join(low, "root").select("fp", "component_id"), "components")
    return fps.join(label, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
