"""Near copies by SimHash and pivot distance tables over word shingles, decided by exact Jaccard similarity.

A text is its set of hashed ``shingle``-word runs (all words, if fewer), texts of one set are one node, and a node's fingerprint
has ``BITS`` sign bits. Sets of Jaccard similarity s differ in each bit with probability acos(2s / (1 + s)) / pi at most (0.15 at 0.8), so
the radius is that mean and 5.8 standard deviations; unrelated texts are some 128 apart. Nodes meet where a block of
bits agrees, in so many blocks that all but ``MISSED`` of the pairs at the very limit meet (nearer ones miss less). In each place
some members are pivots, with a table of their distances to all others: who lies within the radius of a pivot joins its family, and of
the others only those compare whose distances to the pivot differ by no more than the radius.

A family of a place is a meeting of ``links``, which loses no pair of it. Where at most ``FEW`` nodes meet, all their pairs
are verified on the whole sets. A larger meeting is taken apart around a few of its nodes, those that meet most others in all places,
round after round and around ever more of them up to a bound: every node is compared with these centres; those similar to one are linked and leave, the others meet again. Two nodes of distances x and y
from a centre are at least ``|x - y|`` apart, so a leaver and one that stays are compared only at distances where a link
is still possible, first with a few leavers, then, as far as their components are still apart, with those of all that
share one of their rarest differences from the centre (``bridges``); no link between components is lost.
Components come from the rounds of ``simhash.components`` over the nodes.

Null texts count as empty; all texts without words are one node; of a group the row of smallest id stays, null ids last, then by
row number, so repeated rows shrink to one; very long texts are sets like any other; an empty table gives no row.
"""

from __future__ import annotations

from functools import reduce
from math import acos, ceil, log, log1p, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..shipping import discard, materialize, ship_package
from .simhash import components

BITS = 256
WORDS = BITS // 64
#: Bits of a block, up to 2 ** (BLOCK + PLACES_BITS) nodes; then one more for each doubling.
BLOCK, PLACES_BITS = 10, 14
#: Share of the pairs right at the limit of similarity that meet nowhere.
MISSED = 2e-4
SHINGLE, SIMILARITY_PERCENT = 5, 80
FEW = 32
#: Centres of a larger meeting in the first round, the second, and so on; the last holds for all others.
CENTRES = (1, 4, 16, 64, 256)
#: Pairs that are broadcast, of 16 bytes each; more are joined by shuffling.
SENT = 30_000
#: Seats of a task that writes a table of a round; every written file starts processes where the file system is local and Hadoop has no native code.
SEATS = 20_000


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    import xxhash

    words = text.encode().lower().split()
    grams = {b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)))} or {b" ".join(words)} - {b""}
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), dtype=np.uint64, count=len(grams)))


def _words(hashes: np.ndarray) -> np.ndarray:
    """``WORDS`` further hashes of each hash (a finaliser of splitmix64 behind different offsets)."""
    x = hashes[:, None] + np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """SimHash of a set: a bit is 1 if set in over half the hashes; ``WORDS`` words."""
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(_words(hashes[i : i + 4096]).view(np.uint8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * ones > len(hashes)).view(np.uint64)


def apart(percent: int) -> float:
    """The share of bits in which two sets of this similarity differ, at most, on average."""
    return acos(2 * percent / (100 + percent)) / pi


def radius_of(percent: int) -> int:
    p = apart(percent)
    return ceil(BITS * p + 5.8 * sqrt(BITS * p * (1 - p)))


def blocks(percent: int, nodes: int) -> np.ndarray:
    """Bit numbers of each block. Blocks have ``BLOCK`` bits, more where so many nodes would crowd the places."""
    size = max(BLOCK, nodes.bit_length() - PLACES_BITS)
    # Blocks share bits, which makes misses some 1.2 times as many blocks' worth.
    many = ceil(1.2 * log(MISSED) / log1p(-((1 - apart(percent)) ** size)))
    rng, each = np.random.default_rng(80), BITS // size
    return np.concatenate([rng.permutation(BITS)[: each * size].reshape(each, size) for _ in range(-(-many // each))])[:many]


def places(fps: np.ndarray, dealt: np.ndarray) -> np.ndarray:
    """The place of each fingerprint (row) by each block (column)."""
    bits = np.unpackbits(fps.view(np.uint8), axis=1)
    power = 1 << np.arange(dealt.shape[1], dtype=np.int64)
    return np.stack([(bits[:, b] @ power) + (i << 40) for i, b in enumerate(dealt)], axis=1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(y)), dtype=np.int16)
    for i in range(0, len(y), 4096):
        for w in range(WORDS):
            out[:, i : i + 4096] += np.bitwise_count(x[:, w, None] ^ y[None, i : i + 4096, w])
    return out


def families(fps: np.ndarray, radius: int, pivots: int = 256) -> np.ndarray:
    """A number for each fingerprint, alike for those that steps of at most ``radius`` bits connect."""
    family = np.arange(len(fps))

    def join(x, y):  # both: member numbers, pair by pair
        nonlocal family
        while len(x):
            a, b = family[x], family[y]
            to = np.arange(len(fps))
            np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
            family = to[family]
            still = family[x] != family[y]
            x, y = x[still], y[still]

    rest = np.arange(len(fps))
    while len(rest) > 1:
        table = distances(fps[rest[:pivots]], fps[rest])
        at, near = np.nonzero(table <= radius)
        join(rest[at[near > at]], rest[near[near > at]])
        table, rest = table[:, pivots:], rest[pivots:]
        nearest, far = table.argmin(axis=0), table.min(axis=0, initial=BITS)
        leaves = far <= radius
        for p in np.unique(nearest[leaves]):
            mine = np.flatnonzero(leaves & (nearest == p))
            # The pivot's table: of two distances that differ by more than the radius, no link is possible.
            others = np.flatnonzero((table[p] <= far[mine].max() + radius) & (family[rest] != family[rest[mine[0]]]))
            for i in range(0, len(mine), 256):
                x, y = np.nonzero(distances(fps[rest[mine[i : i + 256]]], fps[rest[others]]) <= radius)
                join(rest[mine[i + x]], rest[others[y]])
        rest = rest[~leaves]
    return family


def meetings(nodes: DataFrame, percent: int) -> DataFrame:
    """(k, node): the families of at least two, of all places, of ``nodes`` (node, f: its fingerprint); each family once."""
    dealt, radius = blocks(percent, nodes.count()), radius_of(percent)
    read = lambda column: np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, WORDS)

    def seat(batches):
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                s = b.slice(i, 1024)
                at = pa.array(np.repeat(np.arange(s.num_rows), len(dealt)))
                yield pa.RecordBatch.from_arrays([pa.array(places(read(s.column(1)), dealt).ravel()), s.column(0).take(at), s.column(1).take(at)], ["k", "node", "f"])

    def meet(k, node, fps):
        """Whole places, sorted: their families."""
        import xxhash

        keys, members = [], []
        cuts = np.flatnonzero(np.diff(k)) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(k)]):
            family = families(fps[a:z], radius) if z > a + 1 else np.zeros(0)
            if len(family) and len(set(family.tolist())) < len(family):
                order = np.argsort(family, kind="stable")
                for group in np.split(order, np.flatnonzero(np.diff(family[order])) + 1):
                    if len(group) > 1:
                        own = np.sort(node[a:z][group])
                        keys += [np.uint64(xxhash.xxh64_intdigest(own.tobytes())).view(np.int64)] * len(own)
                        members += own.tolist()
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(members, pa.int64())], ["k", "node"])

    def run(batches):
        held = None  # the last place, which the next batch may go on with
        for b in batches:
            now = b.column(0).to_numpy(), b.column(1).to_numpy(), read(b.column(2))
            now = now if held is None else tuple(map(np.concatenate, zip(held, now)))
            cut = np.searchsorted(now[0], now[0][-1])
            if cut:
                yield meet(*(x[:cut] for x in now))
            held = tuple(x[cut:] for x in now)
        if held:
            yield meet(*held)

    seats = nodes.select("node", "f").mapInArrow(seat, "k long, node long, f binary").repartition("k").sortWithinPartitions("k")
    return materialize(seats.mapInArrow(run, "k long, node long"), "met").distinct()


def _node(hashes: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes())).view(np.int64))


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b), a written table, with the set of each end, x and y."""
    x, y = (sets.select(F.col("node").alias(n), F.col("s").alias(s)) for n, s in (("a", "x"), ("b", "y")))
    if pairs.count() <= SENT:  # few enough to send, so that the sets stay where they are
        return x.join(F.broadcast(pairs), "a").join(y.join(F.broadcast(pairs), "b"), ["a", "b"])
    return pairs.join(x, "a").join(y, "b")


def similarity(pairs: DataFrame, sets: DataFrame, tasks: int) -> DataFrame:
    """(a, b, common, every): sizes of the intersection and the union of two nodes' sets, for each distinct pair; written by ``tasks`` at most."""
    pairs = materialize(pairs.distinct().coalesce(tasks), "pairs")
    both = _with_sets(pairs, sets).withColumn("common", F.size(F.array_intersect("x", "y")).cast("long"))
    return materialize(both.select("a", "b", "common", (F.size("x") + F.size("y") - F.col("common")).alias("every")).coalesce(tasks), "scored")


def bridges(stayed: DataFrame, left: DataFrame, heads: DataFrame, sets: DataFrame, percent: int, tasks: int) -> DataFrame:
    """(b, c): of the nodes ``stayed`` (a, b, root) and ``left`` (a, c, root) beside a centre ``a``, at least the similar pairs of two roots or what links both.

    Centres of one root share the one of most leavers, so a family has one centre however many it was taken apart around. The sets of b and
    c differ where their differences from the centre's set do. For similarity p, of differences B and C at least (u_b + u_c) / 2 (100 + p)
    must be common, u being (100 + p) times the size of the difference less (100 - p) times that of the set. Where that is not more than 0,
    both are similar to the centre, and are linked to it; all others share one of their rarest differences: of n in one order and o to be
    common, of the first n - o + 1.
    """
    write = lambda rows, name: materialize(rows.coalesce(tasks), name)
    more, less = 100 + percent, 100 - percent
    heads = heads.groupBy("a", F.col("root").alias("own")).agg(F.count("*").alias("n"))
    heads = write(heads.join(heads.groupBy("own").agg(F.max(F.struct("n", "a"))["a"].alias("head")), "own").select("a", "own", "head"), "heads")
    sides = stayed.select("a", "b", "root", F.lit(True).alias("stays")).unionByName(left.select("a", F.col("c").alias("b"), "root", F.lit(False).alias("stays")))
    sides = write(sides.join(heads, "a").select(F.col("head").alias("a"), "own", "b", "root", "stays").distinct(), "sides")
    # Who may have a partner: one of another root.
    of = lambda stays, what: F.when(F.col("stays") == stays, F.col(what))
    limits = sides.groupBy("a").agg(*(f(of(s, "root")).alias(f"{n}_{s}") for s in (True, False) for n, f in (("min", F.min), ("max", F.max))))
    other = lambda name: F.when(F.col("stays"), F.col(f"{name}_False")).otherwise(F.col(f"{name}_True"))
    apart = (other("min") != F.col("root")) | (other("max") != F.col("root"))
    sides = write(sides.join(limits, "a").where(apart).select("a", "own", "b", "root", "stays"), "partners")
    beside = _with_sets(write(sides.select("a", "b").distinct(), "ends"), sets).select("a", "b", F.concat(F.array_except("x", "y"), F.array_except("y", "x")).alias("d"), F.size("y").cast("long").alias("n_set"), F.size("x").cast("long").alias("n_centre"))
    u = (F.size("d").cast("long") * more - F.col("n_set") * less).alias("u")
    beside = write(beside.select("a", "b", "n_centre", u, "d"), "differences")
    sides = write(sides.join(beside.drop("d"), ["a", "b"]), "sized")
    each = beside.select("a", "b", F.explode("d").alias("e"))
    # One order for all around a centre: by number of holders there, then by hash.
    ranked = each.join(each.groupBy("a", "e").agg(F.count("*").alias("n")), ["a", "e"]).groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("n", "e"))).alias("d"))
    low = sides.groupBy("a").agg(F.min(of(True, "u")).alias("u_True"), F.min(of(False, "u")).alias("u_False"))
    common = lambda x, y: F.ceil((x + y) / (2 * more))
    first = ranked.join(sides, ["a", "b"]).join(low, "a").withColumn("n", F.size("d")).withColumn("first", F.col("n") - common(F.col("u"), other("u")) + 1)
    first = first.where("first > 0").select("a", "b", "root", "stays", "u", "n", F.posexplode(F.slice("d", F.lit(1), F.col("first").cast("int"))).alias("at", "d"))
    first = write(first.select("a", F.col("d.e").alias("e"), "b", "root", "stays", "u", "n", "at"), "prefixes")
    side = lambda stays, name: first.where(F.col("stays") == stays).select("a", "e", F.col("b").alias(name), *(F.col(x).alias(f"{x}_{name}") for x in ("root", "u", "n", "at")))
    both, needed = side(True, "b").join(side(False, "c"), ["a", "e"]), common(F.col("u_b"), F.col("u_c"))
    both = both.where((F.col("root_b") != F.col("root_c")) & (F.col("at_b") + needed <= F.col("n_b")) & (F.col("at_c") + needed <= F.col("n_c"))).select("b", "c")
    return both.unionByName(sides.where((F.col("u") <= F.col("n_centre") * less) & (F.col("own") != F.col("root"))).select("b", F.col("a").alias("c")))


def links(seats: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of nodes that meet at a seat (k, node) and are similar, enough of them to connect all that are."""
    similar = F.col("common") * 100 >= F.col("every") * percent
    radius = 1 - percent / 100 + 1e-9
    linked = lambda pairs: similarity(pairs, sets, tasks).where(similar).select("a", "b")
    found, stayed, left = [], [], []
    # The slots of the cluster twice over, more for larger tables.
    tasks = max(2 * seats.sparkSession.sparkContext.defaultParallelism, seats.count() // SEATS)
    write = lambda rows, name: materialize(rows.coalesce(tasks), name)
    sizes = seats.groupBy("k").agg(F.count("*").alias("n"))
    # How many others a node meets: the origin of a family meets most of it, its edited copies meet fewer.
    weight = seats.join(sizes, "k").groupBy("node").agg(F.sum("n").alias("weight"))
    seats = seats.join(weight, "node")
    while True:
        crowd = seats.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
        here = write(seats.join(crowd, "k"), "meetings")
        few = here.where(F.col("n") <= FEW)
        every_pair = few.select("k", F.col("node").alias("a")).join(few.select("k", F.col("node").alias("b")), "k").where("a < b").select("a", "b")
        # A family goes with the first centre; crowds that are no family are taken apart around more centres at once.
        many, centres = here.where(F.col("n") > FEW), CENTRES[min(len(found), len(CENTRES) - 1)]
        centre = many.groupBy("k", F.pmod(F.xxhash64("node"), F.lit(centres)).alias("which")).agg(F.max(F.struct("weight", "node"))["node"].alias("a")).select("k", "a")
        many = write(many.select("k", F.col("node").alias("b"), "weight").join(centre, "k").where("a != b"), "compared")
        compared = many.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        scored = similarity(every_pair.unionByName(compared), sets, tasks)
        found.append(scored.where(similar).select("a", "b"))
        pair = scored.select("a", "b", similar.alias("leaves"), (1 - F.col("common") / F.col("every")).alias("far"))
        both = pair.unionByName(pair.select(F.col("b").alias("a"), F.col("a").alias("b"), "leaves", "far"))
        judged = write(many.join(both, ["a", "b"]).select(F.lit(len(found)).alias("turn"), "k", "a", "b", "weight", "leaves", "far"), "judged")
        stayed.append(judged.where(~F.col("leaves") & (F.col("far") <= 2 * radius)).select("turn", "k", "a", "b", "far"))
        # One centre of each leaver, its nearest: whoever is similar to the leaver lies within twice the radius of it.
        nearest = judged.where("leaves").groupBy("turn", "k", F.col("b").alias("c")).agg(F.min(F.struct("far", "a")).alias("m"))
        left.append(write(nearest.select("turn", "k", "c", F.col("m.a").alias("a"), F.col("m.far").alias("near")), "left"))
        rest = judged.groupBy("k", "b").agg(F.max("leaves").alias("leaves"), F.first("weight").alias("weight")).where("not leaves").select("k", F.col("b").alias("node"), "weight")
        seats = rest.join(judged.select("k", F.col("a").alias("node")).distinct(), ["k", "node"], "left_anti")  # a centre was compared with all
        discard(sets.sparkSession)
        if not judged.where("not leaves").limit(1).count():
            break
    found, stayed, left = (reduce(DataFrame.unionByName, x) for x in (found, stayed, left))
    if not stayed.limit(1).count():
        return found
    # Each that stayed near a centre is compared with a few leavers of its meeting first, which connects a family.
    some = left.groupBy("turn", "k", "a").agg(F.array_distinct(F.array(F.min("c"), F.max("c"), F.min_by("c", "near"), F.min_by("c", F.xxhash64("c")))).alias("some"))
    tried = stayed.join(some, ["turn", "k", "a"]).select("b", F.explode("some").alias("c"))
    ends = (F.least("b", "c").alias("a"), F.greatest("b", "c").alias("b"))  # of the two beside the centre
    found = write(found.unionByName(linked(tried.select(*ends))), "links")
    # What is still apart is compared with whom its differences from a centre leave room for a link; in whichever meeting it was beside it.
    root = components(found)
    of = lambda rows, node: rows.join(root.withColumnRenamed("fp", node), node, "left").withColumn("root", F.coalesce("root", node))
    bridge = bridges(of(stayed, "b"), of(left, "c"), of(left, "a"), sets, percent, tasks)
    return found.unionByName(linked(bridge.select(*ends)))


def near_groups(docs: DataFrame, row: str, shingle: int = SHINGLE, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """``row``, doc_id, component_id (smallest id linked) and kept of every row; links are pairs of Jaccard similarity of ``percent`` or more.

    ``row`` names a column of unique numbers; ``docs`` is read twice and must give the same numbers.
    """
    ship_package(docs.sparkSession)

    def sketch(batches):
        for b in batches:
            sets = [shingle_set(t, shingle) for t in b.column(2).to_pylist()]
            cols = [b.column(0), b.column(1), pa.array(map(_node, sets), pa.int64()), pa.array([fingerprint(s).tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["row", "doc_id", "node", "f"])

    def whole(batches):
        for b in batches:
            for t in b.column(0).to_pylist():
                s = shingle_set(t, shingle)
                yield pa.RecordBatch.from_arrays([pa.array([_node(s)], pa.int64()), pa.array([s.view(np.int64)], pa.list_(pa.int64()))], ["node", "s"])

    rows = docs.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    sketches = materialize(rows.mapInArrow(sketch, "row long, doc_id long, node long, f binary"), "sketches")
    nodes = materialize(sketches.groupBy("node").agg(F.first("f").alias("f"), F.min("row").alias("row")), "nodes")
    seats = materialize(meetings(nodes, percent), "seats")
    # One text of each node that has met another.
    first = nodes.join(seats.select("node").distinct(), "node", "left_semi").select("row").hint("merge")
    sets = materialize(rows.join(first, "row").select("t").mapInArrow(whole, "node long, s array<long>"), "sets")
    linked = materialize(links(seats, sets, percent), "links")
    discard(docs.sparkSession, sets)
    root = components(linked).select(F.col("fp").alias("node"), "root")
    groups = sketches.select("row", "doc_id", "node").join(root, "node", "left").select("row", "doc_id", F.coalesce("root", "node").alias("g"))
    best = groups.groupBy("g").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("k"))
    out = groups.join(best, "g")
    return out.select(F.col("row").alias(row), "doc_id", F.col("k.doc_id").alias("component_id"), (F.col("row") == F.col("k.row")).alias("kept"))
