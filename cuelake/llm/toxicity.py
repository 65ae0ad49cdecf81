"""Operator 9: toxicity by a weighted finite-state pattern grammar over clauses.

A word is read as a symbol: insult (of four strengths, from stems that labelled training rows show), threat, target, negation,
report, or other. Four transducers are composed into one machine with a compiled table of states: negation marks the hits
up to ``NEGATION_REACH`` words behind it, reported speech marks the hits behind a verb of saying, targeting pairs a hit with a
target of its clause in either order, and the last one turns each marked hit into an event. A clause is one run of the
machine. A text's events are counted, dampened by ``log1p`` (in fitting and in scoring alike, so length alone does not add
up), and weighted by a logistic model whose weights start from the grammar's own and are fitted on the training rows.

Fitted on at most ``SAMPLE_ROWS`` labelled rows, those of smallest id hash; Spark counts their stems and events, the driver gets
the lexicon's stems and one short vector for each row. Null and empty texts have no clause and get the offset's score; repeated
rows are each scored, null ids too (never held out); an empty table gives no row; without training rows of both labels
no stem is learned and the grammar's own weights hold. Very long texts are read clause by clause. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..shipping import materialize, ship_package

SAMPLE_ROWS = 6_000
STEM_CHARS = 5
MIN_ROWS, MIN_LOG_ODDS = 3, 2.5
NEGATION_REACH = 3
OFFSET = -4.0
#: Fixed word lists of the grammar: English, German, French, Spanish. Threats are beginnings of words.
THREATS = "kill murder hurt destroy attack beat crush shoot stab strangle töte umbring vernicht schlag erschieß tuer frapper détruir étrangl matar golpear destruir dispar".split()
TARGETS = "you your yours u ya he she they them him her people everyone du dich dir dein deine ihr euch sie ihn alle tu te toi vous vos ton ta ils elles lui tú ti usted ustedes vosotros ellos ellas él ella".split()
NEGATIONS = "not never no nobody isn't aren't don't doesn't won't nicht nie kein keine niemand ne pas jamais aucun nunca jamás ningún nadie".split()
REPORTS = "said says reported quoted claims claimed wrote called sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó".split()
_CLAUSE = re.compile(r"[.!?;\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
#: Least log odds of each strength of insult, and the weight that an event of it starts from.
LEVELS = ((MIN_LOG_ODDS, 3.0), (3.5, 4.0), (4.5, 5.0), (5.5, 6.0))
HITS = tuple(f"insult{k}" for k in range(len(LEVELS))) + ("threat",)
ALPHABET = (*HITS, "target", "negation", "report", "other")
MARKS = ("plain", "negated", "reported")
#: Events: hit, mark, directed at a target or not. A directed event adds to the undirected one.
EVENTS = tuple(product(HITS, MARKS, (False, True)))


class Transducer(NamedTuple):
    """``step(state, symbol)`` and ``end(state)`` give the next state and the symbols written."""

    start: object
    step: Callable
    end: Callable


def negation() -> Transducer:
    """Writes (symbol, mark); the state is how many words the negation still reaches."""

    def step(left, s):
        if s == "negation":
            return NEGATION_REACH, ()
        return max(0, left - 1), ((s, "negated" if left and s in HITS else "plain"),) if s != "other" else ()

    return Transducer(0, step, lambda left: ())


def reporting() -> Transducer:
    """A hit behind a verb of saying is reported, unless it is negated."""

    def step(said, s):
        kind, mark = s
        if kind == "report":
            return True, ()
        return said, ((kind, "reported" if said and mark == "plain" and kind in HITS else mark),)

    return Transducer(False, step, lambda said: ())


def targeting() -> Transducer:
    """Writes each hit, and again as directed once a target stands in its clause; the state: target seen, and the hit waiting for one."""

    def step(state, s):
        seen, waiting = state
        if s[0] == "target":
            return (True, None), ((waiting, True),) if waiting else ()
        out = ((s, False),) + (((s, True),) if seen else ())
        return (seen, None if seen else s), out

    return Transducer((False, None), step, lambda state: ())


def numbering() -> Transducer:
    place = {e: i for i, e in enumerate(EVENTS)}
    return Transducer(None, lambda _, s: (None, (place[s[0][0], s[0][1], s[1]],)), lambda _: ())


def compose(a: Transducer, b: Transducer) -> Transducer:
    """What ``a`` writes is read by ``b``."""

    def feed(state, symbols):
        out = ()
        for s in symbols:
            state, more = b.step(state, s)
            out += more
        return state, out

    def step(state, symbol):
        x, written = a.step(state[0], symbol)
        y, out = feed(state[1], written)
        return (x, y), out

    def end(state):
        y, out = feed(state[1], a.end(state[0]))
        return out + b.end(y)

    return Transducer((a.start, b.start), step, end)


def compiled(t: Transducer, alphabet=ALPHABET) -> tuple[list[list[int]], list[list[tuple]], list[tuple]]:
    """Reachable states as tables: next state and events of each (state, symbol), and events at the end of a clause."""
    number, todo, after, out, end = {t.start: 0}, [t.start], [], [], []
    while todo:
        s = todo.pop(0)
        moves = [t.step(s, a) for a in alphabet]
        for x, _ in moves:
            if x not in number:
                number[x] = len(number)
                todo.append(x)
        after.append([number[x] for x, _ in moves])
        out.append([o for _, o in moves])
        end.append(t.end(s))
    return after, out, end


def machine():
    return compiled(compose(compose(compose(negation(), reporting()), targeting()), numbering()))


def own_weights() -> np.ndarray:
    """The grammar's weights before fitting: negation halves a hit, reported speech takes a third, a target adds a tenth; threats need one."""
    cut = {"plain": 1.0, "negated": 0.5, "reported": 0.7}
    strength = {f"insult{k}": w for k, (_, w) in enumerate(LEVELS)}
    of = lambda hit, mark, directed: cut[mark] * ((3.0 if directed else 0.5) if hit == "threat" else strength[hit] * (0.1 if directed else 1.0))
    return np.array([of(*e) / math.log(2) for e in EVENTS])


def stems(word: str) -> tuple[str, ...]:
    """Features of a word: itself and, if longer, its leading characters."""
    return (word, word[:STEM_CHARS] + "*") if len(word) > STEM_CHARS else (word,)


class Grammar:
    """``lexicon``: log odds of insult stems."""

    def __init__(self, lexicon: dict[str, float], offset: float = OFFSET, weights=None):
        self.lexicon, self.offset = lexicon, offset
        self.weights = own_weights() if weights is None else np.asarray(weights, dtype=float)
        self.after, self.out, self.end = machine()
        place = {s: i for i, s in enumerate(ALPHABET)}
        self.other, self.hits = place["other"], len(HITS)
        self.fixed = {w: place[k] for k, ws in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)) for w in ws}
        self.memo: dict[str, int] = {}

    def symbol(self, w: str) -> int:
        odds = max((self.lexicon.get(s, 0.0) for s in stems(w)), default=0.0)
        if odds >= LEVELS[0][0]:
            s = max(k for k, (least, _) in enumerate(LEVELS) if odds >= least)
        elif w in self.fixed:
            s = self.fixed[w]
        else:
            s = self.hits - 1 if w.startswith(tuple(THREATS)) else self.other
        if len(self.memo) > 300_000:
            self.memo = {}
        self.memo[w] = s
        return s

    def events(self, text: str) -> Counter:
        """Events of a text, counted: one run of the machine for each clause that has a hit."""
        got, memo, hits = Counter(), self.memo, self.hits
        for clause in _CLAUSE.split(text.lower()):
            run = [memo[w] if w in memo else self.symbol(w) for w in _WORD.findall(clause)]
            if run and min(run) < hits:
                state = 0
                for s in run:
                    got.update(self.out[state][s])
                    state = self.after[state][s]
                got.update(self.end[state])
        return got

    def features(self, text: str) -> dict[int, float]:
        return {e: math.log1p(n) for e, n in self.events(text).items()}

    def weight(self, text: str) -> float:
        return float(sum(self.weights[e] * x for e, x in self.features(text).items()))

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.offset + self.weight(text)))))


def fit(x: np.ndarray, y: np.ndarray, prior: np.ndarray, offset: float = OFFSET, steps: int = 50) -> tuple[float, np.ndarray]:
    """Newton steps of a logistic model whose weights are drawn to ``prior`` (variance 1), its offset to ``offset`` (variance 100)."""
    a = np.hstack([np.ones((len(x), 1)), x])
    mean = np.concatenate([[offset], prior])
    pull = np.concatenate([[0.01], np.ones(len(prior))])
    w = mean.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (y - p) - pull * (w - mean)
        change = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(pull), gradient)
        w = w + change / max(1.0, np.abs(change).max())
        if np.abs(change).max() < 1e-9:
            break
    return float(w[0]), w[1:]


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Counted(NamedTuple):
    """Rows of each label, and the stems that some lexicon may hold: (stem, toxic rows, other rows)."""

    toxic: int
    other: int
    stems: list[tuple[str, int, int]]

    def lexicon(self, without: int | None = None) -> dict[str, float]:
        """Log odds of stems whose rows are toxic far more often: in ``MIN_ROWS`` toxic rows or more, twice as many as others.

        ``without``: the label of one row that is left out of all counts, so that fitting does not score a row by itself.
        """
        d1, d0 = int(without == 1), int(without == 0)
        out = {}
        for s, c1, c0 in self.stems:
            c1, c0 = c1 - d1, max(0, c0 - d0)
            odds = math.log((c1 + 0.5) / (self.toxic - d1 + 1)) - math.log((c0 + 0.5) / (self.other - d0 + 1))
            if c1 >= MIN_ROWS and c1 > 2 * c0 and odds >= MIN_LOG_ODDS:
                out[s] = odds
        return out


def count_stems(rows: DataFrame) -> Counted:
    """``rows``: (t, toxic), at most ``SAMPLE_ROWS``. Stems are counted by Spark; those too rare for any lexicon stay there."""
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def run(batches):
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = sorted({s for w in set(_WORD.findall(t.lower())) for s in stems(w)})
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y] * len(found), pa.int32())], ["stem", "toxic"])

    seen = rows.select("t", "toxic").mapInArrow(run, "stem string, toxic int").groupBy("stem").agg(F.sum("toxic").alias("c1"), F.sum(1 - F.col("toxic")).alias("c0"))
    found = seen.where((F.col("c1") >= MIN_ROWS) & (F.col("c1") > 2 * (F.col("c0") - 1))).collect()
    return Counted(size.get(1, 0), size.get(0, 0), sorted((r["stem"], r["c1"], r["c0"]) for r in found))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Grammar:
    ship_package(docs.sparkSession)
    ids = labels.where("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    ids = ids.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    rows = materialize(rows.join(F.broadcast(ids), "doc_id").select("t", "toxic"), "labelled")  # at most SAMPLE_ROWS ids
    counted = count_stems(rows)
    lexicon = counted.lexicon() if counted.toxic and counted.other else {}
    if not lexicon:
        return Grammar({})
    without = [counted.lexicon(0), counted.lexicon(1)]

    def run(batches):
        g = [Grammar(x) for x in without]
        for b in batches:
            found = [g[y].features(t) for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            dense = [[f.get(e, 0.0) for e in range(len(EVENTS))] for f in found]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(dense, pa.list_(pa.float64()))], ["toxic", "x"])

    # One short vector for each of at most SAMPLE_ROWS rows; sorted, so that sums do not depend on their order.
    got = sorted((r["toxic"], tuple(r["x"])) for r in rows.select("t", "toxic").mapInArrow(run, "toxic int, x array<double>").collect())
    offset, weights = fit(np.array([x for _, x in got]), np.array([y for y, _ in got], dtype=float), own_weights())
    return Grammar(lexicon, offset, weights)


def probability(docs: DataFrame, grammar: Grammar, text: str = "text"):
    """Column of the scores of ``text``, so that a row's other columns need not leave the JVM."""
    ship_package(docs.sparkSession)
    made = (grammar.lexicon, grammar.offset, grammar.weights.tolist())
    held: list[Grammar] = []

    def run(texts):
        if not held:
            held.append(Grammar(*made))
        return pa.array([held[0].score(t or "") for t in texts.to_pylist()], pa.float64())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")(F.col(text))


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), probability(docs, grammar).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
