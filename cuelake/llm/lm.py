"""Operator 2: language-model scores from a weighted backoff automaton.

N-grams of order 1 to 3 over all training tokens, without a cut-off. States: the root, one for each known word, one for each known
pair of words; a state stands for the longest known end of what was read. An arc of a state (known n-gram) has the smoothed
probability of its word there; a word without an arc takes the state's failure arc, which has the weight of backing off, to the
state of the shorter history, and at the root the arc of the unknown word. Smoothing draws every state's counts towards
the shorter history's probabilities with ``PULL`` tokens' worth of them, so each state's probabilities sum to 1 over the
vocabulary and the unknown word, one class that holds the words' discounted mass. A text starts behind an end token and is
read once, left to right: the state is carried from token to token and log10 weights add up. Texts of a block are read side by
side, long ones in stretches of ``STRETCH`` tokens (2 at least), each started by reading the two tokens before it.

Training texts are those whose crc32(doc_id) mod 7 is not 2, all of them whole. Each input partition makes blocks of about
``BLOCK_CHARS`` characters; a block is written as word numbers, and asks for the counts of its own distinct n-grams: sorted
64-bit keys in compressed parcels, one for each part of the key space, whose owner adds them up and answers in the same
order. Pairs and words are asked first; a triple is asked only if both its pairs occur in another block too, learned from or not,
since else no other block can have it and the block's own count is the corpus's. So what a worker holds depends on the block and the part, never on the vocabulary.

Null texts count as empty and are one end token; very long texts make a block of their own; repeated rows are each scored; null
ids are learned from and not held out; extra columns are ignored; an empty table gives no row; without training rows every word
is unknown, of score 0.
"""

from __future__ import annotations

import ctypes
import struct
import sys
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..shipping import discard, materialize, ship_package

BLOCK_CHARS = 4_000_000
#: Characters of text whose n-grams one part of the key space owns, about.
PART_CHARS = 16_000_000
DISCOUNT = 0.75
#: Tokens' worth of the shorter history, behind one word and behind two.
PULL = (100.0, 20.0)
STRETCH = 512
END = b"\n"  # cannot be a word
_BLOB = "blk long, part int, blob binary"


def _words(text: str) -> list[bytes]:
    w = text.encode().lower().split()
    w.append(END)
    return w


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed parcel, bytes of the same place together, which compresses what is small or sorted."""
    import zstandard

    head, body = [struct.pack("<I", len(arrays))], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head.append(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)))
        body.append(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if len(a) else b"")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + body))


def _unpack(blob) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(bytes(blob))
    n, at, out = struct.unpack_from("<I", raw)[0], 4, []
    kinds = [struct.unpack_from("<2sQ", raw, at + 10 * k) for k in range(n)]
    at += 10 * n
    for kind, size in kinds:
        dtype = np.dtype("<" + kind.decode())
        end = at + size * dtype.itemsize
        out.append(np.frombuffer(raw, np.uint8, end - at, at).reshape(dtype.itemsize, size).T.copy().view(dtype).ravel() if size else np.array([], dtype))
        at = end
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences, which are small."""
    return np.diff(keys, prepend=np.uint64(0))


class Block:
    """Texts as word numbers. ``h``: key of each distinct word; ``own1``, ``own2``: counts of its words and pairs that are learned from.

    ``counts``, once known: those of the corpus, and whether each pair occurs in another block.
    """

    def __init__(self, doc_ids, none, held, sizes, ids, h, counts=()):
        self.doc_ids, self.none, self.held, self.sizes, self.ids, self.h, self.counts = doc_ids, none, held, sizes, ids, h, counts
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.train = np.repeat(held == 0, sizes)
        end = ids[-1]
        before = np.concatenate([[end], ids[:-1]]).astype(np.int64)
        before[self.starts] = end
        self.pairs, self.pair_of = np.unique(before << 32 | ids, return_inverse=True)
        a, b = self.pairs >> 32, self.pairs & 0xFFFFFFFF
        self.pair_words = (a, b)
        self.pair_keys = _mix(_mix(h[a] + np.uint64(1)) ^ h[b])
        self.own1 = np.bincount(ids[self.train], minlength=len(h))
        self.own2 = np.bincount(self.pair_of[self.train], minlength=len(self.pairs))
        self.held2 = np.bincount(self.pair_of[~self.train], minlength=len(self.pairs))

    def triples(self):
        """Distinct (pair before, word): key, pair before, pair after, own count, and whether another block may have it."""
        inner = np.ones(len(self.ids), dtype=bool)
        inner[self.starts] = False
        at = np.flatnonzero(inner)
        before, after = self.pair_of[at - 1], self.pair_of[at]
        found, first, place = np.unique(before.astype(np.int64) << 32 | self.ids[at], return_index=True, return_inverse=True)
        before, after = before[first], after[first]
        keys = _mix(_mix(self.pair_keys[before] + np.uint64(2)) ^ self.h[self.pair_words[1][after]])
        own = np.bincount(place[self.train[at]], minlength=len(found))
        shared = self.counts[2].astype(bool)
        return keys, before, after, own, shared[before] & shared[after]

    def pack(self) -> bytes:
        return _pack(self.doc_ids, self.none, self.held, self.sizes, self.ids.astype(np.uint32), self.h, *self.counts)

    @classmethod
    def unpack(cls, blob) -> "Block":
        doc_ids, none, held, sizes, ids, h, *counts = _unpack(blob)
        return cls(doc_ids, none, held, sizes, ids.astype(np.int64), h, counts)


def _blocks(batches, block_chars: int):
    """Blocks of an input partition's rows (doc_id, t, held_out)."""
    import xxhash

    doc_ids, held, tokens, chars, made = [], [], [], 0, 0
    number = defaultdict(count().__next__)

    def out():
        h = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), dtype=np.uint64, count=len(number))
        sizes = np.array([len(x) for x in tokens], dtype=np.uint32)
        none = np.array([d is None for d in doc_ids], dtype=np.uint8)
        block = _pack(np.array([d or 0 for d in doc_ids], dtype=np.int64), none, np.array(held, dtype=np.uint8), sizes, np.concatenate(tokens), h)
        blk = TaskContext.get().partitionId() << 32 | made
        return pa.RecordBatch.from_arrays([pa.array([blk], pa.int64()), pa.array([int(sizes.sum())], pa.int64()), pa.array([chars], pa.int64()), pa.array([block], pa.binary())], ["blk", "n", "chars", "blob"])

    for b in batches:
        for d, t, x in zip(b.column(0), b.column(1), b.column(2)):
            t = t.as_py()
            doc_ids.append(d.as_py())
            held.append(x.as_py())
            tokens.append(np.fromiter(map(number.__getitem__, _words(t)), dtype=np.uint32))
            chars += len(t)
            if chars >= block_chars:
                yield out()
                made += 1
                doc_ids, held, tokens, chars = [], [], [], 0
                number.clear()
                number = defaultdict(count().__next__)
    if doc_ids:
        yield out()


def _ask(blk: int, keys: np.ndarray, counts: list[np.ndarray], parts: int, kind: int):
    """Parcels of sorted keys with the block's own counts, one for each part of the key space."""
    order = np.argsort(keys)
    keys, counts = keys[order], [c[order].astype(np.uint32) for c in counts]
    width = 2**64 // parts + 1
    cuts = np.searchsorted(keys, np.array([p * width for p in range(1, parts)], dtype=np.uint64)).tolist()
    for p, (a, z) in enumerate(zip([0, *cuts], [*cuts, len(keys)])):
        if z > a:
            yield blk, p * 2 + kind, _pack(_steps(keys[a:z]), *(c[a:z] for c in counts))


def _rows(rows):
    rows = list(rows)
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], ["blk", "part", "blob"])


def _total(key, table):
    """The owner of a part of the key space: counts of all blocks added up; the answers have each asker's order. Row -1: tokens, kinds."""
    part = key[0].as_py()
    asked = [_unpack(b.as_py()) for b in table.column("blob")]
    keys = [np.cumsum(x[0], dtype=np.uint64) for x in asked]
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    columns = [np.concatenate(c) for c in zip(*(x[1:] for x in asked))]
    total = [np.bincount(place, weights=c, minlength=len(found)).astype(np.uint64) for c in columns]  # exact up to 2 ** 53
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    answers = [_pack(*(t[p] for t in total)) for p in np.split(place, cuts)]
    blks = table.column("blk").to_pylist()
    del found, place, columns, keys, asked
    _trim()
    mine = _pack(np.array([total[0].sum(), np.count_nonzero(total[0])], dtype=np.uint64))
    return pa.table({"blk": pa.array([*blks, -1], pa.int64()), "part": pa.array([part] * (len(blks) + 1), pa.int32()), "blob": pa.array([*answers, mine], pa.binary())})


def _answered(keys: np.ndarray, answers: dict[int, bytes], kind: int, n: int = 1) -> list[np.ndarray]:
    """The ``n`` counts of ``keys`` from the answers of all parts, in the order of ``keys``."""
    out, order = [np.zeros(len(keys), dtype=np.int64) for _ in range(n)], np.argsort(keys)
    got = [_unpack(answers[p]) for p in sorted(answers) if p % 2 == kind]
    for x, parts in zip(out, zip(*got)):
        x[order] = np.concatenate(parts).astype(np.int64)
    return out


def _trim() -> None:
    """Give freed memory back to the system, since a worker stays idle beside others."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def _open(table) -> tuple[Block | None, dict[int, bytes], int]:
    blk = table.column("blk")[0].as_py()
    rows = dict(zip(table.column("part").to_pylist(), table.column("blob").to_pylist()))
    block = rows.pop(-1, None)
    return block and Block.unpack(block), rows, blk


class Automaton:
    """States 0: root, then words, then pairs, as far as a block meets them; arcs sorted by (state, word)."""

    def __init__(self, block: Block, n: int, v: int, triples, c3: np.ndarray, pull: tuple[float, float]):
        words, (first, last) = len(block.h), block.pair_words
        c1, c2 = block.counts[0].astype(np.float64), block.counts[1].astype(np.float64)
        root = np.where(c1 > 0, (c1 - DISCOUNT) / n, DISCOUNT * v / n)
        known2 = c2 > 0
        p2 = (c2 + pull[0] * root[last]) / (c1[first] + pull[0])
        _, before, after, *_ = triples
        known3 = c3 > 0
        before, after, c3 = before[known3], after[known3], c3[known3]
        p3 = (c3 + pull[1] * p2[after]) / (c2[before] + pull[1])
        pair_state = np.where(known2, words + 1 + np.arange(len(c2)), 0)
        with np.errstate(divide="ignore"):
            self.root_next, self.root_weight = np.where(c1 > 0, np.arange(words) + 1, 0), np.log10(root)
        self.fail = np.concatenate([np.zeros(words + 1, dtype=np.int64), last + 1])
        self.fail_weight = np.concatenate([[0.0], np.log10(pull[0] / (c1 + pull[0])), np.log10(pull[1] / (c2 + pull[1]))])
        key = np.concatenate([(first[known2] + 1) << 32 | last[known2], pair_state[before] << 32 | last[after]])
        order = np.argsort(key)
        self.key = np.append(key[order], np.iinfo(np.int64).max)
        self.weight = np.log10(np.concatenate([p2[known2], p3]))[order]
        self.next = np.concatenate([pair_state[known2], pair_state[after]])[order]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states and the log10 weights of reading one word in each state: failure arcs until there is an arc."""
        out, got, live, at = np.zeros(len(word)), np.empty(len(word), dtype=np.int64), np.arange(len(word)), state
        while True:
            inner = at > 0
            done = live[~inner]
            out[done] += self.root_weight[word[done]]
            got[done] = self.root_next[word[done]]
            live, at = live[inner], at[inner]
            if not len(live):
                return got, out
            key = at << 32 | word[live]
            arc = np.searchsorted(self.key, key)
            hit = self.key[arc] == key
            out[live[hit]] += self.weight[arc[hit]]
            got[live[hit]] = self.next[arc[hit]]
            live, at = live[~hit], at[~hit]
            out[live] += self.fail_weight[at]
            at = self.fail[at]

    def read(self, block: Block, stretch: int) -> np.ndarray:
        """Log10 weight of every token, read left to right in stretches side by side."""
        ids, end = block.ids, block.ids[-1]
        begin = np.concatenate([np.arange(s, s + n, stretch) for s, n in zip(block.starts, block.sizes)])
        text = np.repeat(np.arange(len(block.sizes)), -(-block.sizes.astype(np.int64) // stretch))
        stop = np.minimum(begin + stretch, (block.starts + block.sizes)[text])
        order = np.argsort(begin - stop, kind="stable")
        begin, stop, start = begin[order], stop[order], block.starts[text[order]]
        # Where a text begins, an end token was read; else the state follows from the two tokens before.
        inside = self.step(self.root_next[ids[np.maximum(begin - 2, 0)]], ids[np.maximum(begin - 1, 0)])[0]
        state = np.where(begin > start, inside, self.root_next[end])
        weight = np.zeros(len(ids))
        for k in range(stretch):
            live = int(np.searchsorted(begin - stop, -k, side="left"))
            if not live:
                break
            at = begin[:live] + k
            state, weight[at] = self.step(state[:live], ids[at])
        return weight


def scores(docs: DataFrame, pull=PULL, block_chars: int = BLOCK_CHARS, part_chars: int = PART_CHARS, stretch: int = STRETCH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"), held_out().alias("held_out"))
    blocks = materialize(rows.mapInArrow(lambda batches: _blocks(batches, block_chars), "blk long, n long, chars long, blob binary"), "blocks")
    chars = blocks.agg(F.sum("chars")).first()[0] or 0
    parts = chars // part_chars + 1

    def ask_pairs(batches):
        for b in batches:
            for blk, blob in zip(b.column(0).to_pylist(), b.column(1)):
                x = Block.unpack(blob.as_py())
                yield _rows(_ask(blk, x.h, [x.own1], parts, 0))
                yield _rows(_ask(blk, x.pair_keys, [x.own2, x.held2], parts, 1))

    def fold(_, table):
        x, got, blk = _open(table)
        c2, held = _answered(x.pair_keys, got, 1, 2)
        x.counts = [*_answered(x.h, got, 0), c2, (c2 + held > x.own2 + x.held2).astype(np.uint8)]
        out = pa.Table.from_batches([_rows([(blk, -1, x.pack())])])
        del x
        _trim()
        return out

    def ask_triples(batches):
        for b in batches:
            for blk, blob in zip(b.column(0).to_pylist(), b.column(1)):
                keys, _, _, own, shared = Block.unpack(blob.as_py()).triples()
                yield _rows(_ask(blk, keys[shared], [own[shared]], parts, 0))

    def owned(ask, states):
        """Owners' answers; asked parcels go to the owner of their part."""
        return states.select("blk", "blob").mapInArrow(ask, _BLOB).groupBy("part").applyInArrow(_total, _BLOB)

    states = blocks.select("blk", F.lit(-1).alias("part"), "blob")
    answers = materialize(owned(ask_pairs, states), "answers")
    discard(spark)
    n = v = 0
    for r in answers.where("blk < 0 and part % 2 = 0").select("blob").collect():  # one row of two numbers for each part
        tokens, kinds = _unpack(r["blob"])[0].tolist()
        n, v = n + tokens, v + kinds
    counted = materialize(states.unionByName(answers.where("blk >= 0")).groupBy("blk").applyInArrow(fold, _BLOB), "counted")
    del states
    discard(spark, blocks, answers)
    told = owned(ask_triples, counted).where("blk >= 0")

    def run(_, table):
        x, got, _ = _open(table)
        c1 = x.counts[0]
        base = np.log10((c1 + 1) / (n + v + 1))[x.ids]
        if n:
            triples = x.triples()
            keys, _, _, own, shared = triples
            c3 = own.copy()
            (c3[shared],) = _answered(keys[shared], got, 0)
            weight = Automaton(x, n, v, triples, c3, pull).read(x, stretch)
            del triples, keys, own, shared, c3
        else:
            weight = np.zeros(len(x.ids))
        per_text = lambda a: np.add.reduceat(a, x.starts)
        cols = (
            pa.array(x.doc_ids, pa.int64(), mask=x.none.astype(bool)),
            pa.array(x.held.astype(bool)),
            pa.array(x.sizes.astype(np.int64)),
            pa.array(per_text((c1 > 0).astype(np.int64)[x.ids])),
            pa.array(np.full(len(x.sizes), n)),
            pa.array(per_text(base)),
            pa.array(per_text(weight)),
        )
        del x, base, weight
        _trim()
        return pa.table(dict(zip(names, cols)))

    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return counted.unionByName(told).groupBy("blk").applyInArrow(run, schema)
