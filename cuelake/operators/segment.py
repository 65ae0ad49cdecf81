"""Optimal caption segmentation: candidates of each track, a shortest path over them, then repair.

The costs of borders are native. Candidates (every run of words that may be one caption, with its cost) are priced as arrays over
a track's words; the path, padding and merging depend on order. Both run track by track, so a track must fit in one task. Null words are no words; a track that
cannot be cut within the limits is reported as infeasible by ``track_status``; ties go to the earlier start.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import lexical
from .folding import by_tracks, in_rows

SCHEMA = "track_id long, idx int, word_start int, word_end int, start double, end double, duration double, planned double, chars int, cps double, cost double, text string"


@dataclass(frozen=True)
class Limits:
    """Seconds, characters, and characters a second of one caption."""

    min_dur: float = 5 / 6
    max_dur: float = 7.0
    max_chars: int = 42
    max_cps: float = 20.0


def _words(words: DataFrame) -> DataFrame:
    """Usable words with their neighbours' times, ``border``, the trimmed ``token``, and whether it is ``untidy``."""
    w = W.partitionBy("track_id").orderBy("pos")
    rows = words.where("word is not null and start_ms is not null and end_ms is not null").select("track_id", "pos", "word", (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"))
    rows = lexical.with_signs(rows).withColumn("token", F.trim("word")).withColumn("untidy", lexical.untidy(F.col("token")))
    rows = rows.withColumns({"next_signs": F.lead("signs").over(w), "next_start": F.lead("start").over(w), "before": F.coalesce(F.lag("end").over(w), F.lit(0.0))})
    return rows.withColumn("border", lexical.border_cost(F.col("word"), F.col("signs"), F.col("next_signs"), F.col("next_start") - F.col("end"))).drop("signs", "next_signs")


def borders(words: DataFrame) -> DataFrame:
    """track_id, pos, word, start, end (seconds), next_start, and ``border``: the cost of ending a caption behind the word."""
    return _words(words).select("track_id", "pos", "word", "start", "end", "next_start", "before", "border")


#: Words whose runs are priced at once.
BLOCK = 65_536


def _table(words: DataFrame, lim: Limits) -> DataFrame:
    """What ``runs`` needs of each word."""
    return _words(words).select("track_id", "pos", "word", "token", "start", "end", "before", F.coalesce("next_start", F.col("end") + lim.min_dur).alias("behind"), "border", "untidy", F.length("word").alias("n"), F.length("token").alias("width"))


#: Columns of ``_table`` that come as arrays.
NUMBERS = ("pos", "start", "end", "before", "behind", "border", "untidy", "n", "width")


def runs(track: dict, lim: Limits, first: int, size: int, made: Callable[[int, int], str]):
    """Runs that may be one caption, of the words ``first`` to ``first + size``: arrays (i, j, planned, chars, cps, cost) by first word, then last.

    A word has at least one character, so a run has at most ``max_chars`` words. Differences of sums over the track give a run's
    length; only a run with an untidy word must be ``made`` and tidied before it can be measured.
    """
    start, end, before, behind, border = (track[c] for c in ("start", "end", "before", "behind", "border"))
    last = min(first + size, len(start))
    raw_n, n, odd = (np.concatenate([[0], np.cumsum(track[c][first : last + lim.max_chars], dtype=np.int64)]) for c in ("n", "width", "untidy"))
    parts, i = [], np.arange(first, last)
    for k in range(lim.max_chars):
        i = i[i < len(start) - k]
        # Tidying may take a space before punctuation, never a character of a word.
        i = i[raw_n[i + k + 1 - first] - raw_n[i - first] <= lim.max_chars]
        if not len(i):
            break
        j, raw = i + k, end[i + k] - start[i]
        fit = (raw > 0) & (raw <= lim.max_dur)
        a, j, raw = i[fit], j[fit], raw[fit]
        chars = n[j + 1 - first] - n[a - first] + k
        for x in np.flatnonzero(odd[j + 1 - first] > odd[a - first]):
            chars[x] = len(made(int(a[x]), int(j[x])))
        room = np.maximum(0.0, start[a] - before[a]) + np.maximum(0.0, behind[j] - end[j]) + 0.18
        shown = np.minimum(lim.max_dur, raw + room)
        need = np.maximum(raw, chars / lim.max_cps)
        full = np.maximum(need, lim.min_dur)
        planned = np.where(full > shown + 1e-6, need, full)
        cps = chars / planned
        ok = (chars <= lim.max_chars) & (chars / lim.max_cps <= shown + 1e-6) & (cps <= lim.max_cps + 1e-6)
        a, j, planned, chars, cps = (x[ok] for x in (a, j, planned, chars, cps))
        over = lambda x, limit, weight: np.maximum(0.0, x - limit) * weight
        cost = 1.0 + border[j] + over(cps, lim.max_cps * 0.88, 1.4) + over(chars, lim.max_chars * 0.9, 0.08) + over(lim.min_dur + 0.18 - planned, 0.0, 0.9)
        parts.append((a, j, planned, chars, cps, cost))
    found = [np.concatenate(x) for x in zip(*parts)] or [np.zeros(0, int)] * 6
    order = np.lexsort((found[1], found[0]))
    return [x[order] for x in found]


def candidates(words: DataFrame, lim: Limits = Limits()) -> DataFrame:
    """``runs`` of every track with their texts: track_id, i, j (positions), start, end, planned, text, chars, cps, cost."""

    def run(track: dict):
        tokens, pos = track["token"], track["pos"]
        line, at = " ".join(tokens), np.concatenate([[0], np.cumsum(track["width"] + 1)])
        odd = np.concatenate([[0], np.cumsum(track["untidy"])])
        made = lambda i, j: lexical.clean_py(line[at[i] : at[j + 1] - 1])
        for first in range(0, len(tokens), BLOCK):
            i, j, planned, chars, cps, cost = runs(track, lim, first, BLOCK, made)
            texts = [line[a:z] for a, z in zip(at[i].tolist(), (at[j + 1] - 1).tolist())]
            for x in np.flatnonzero(odd[j + 1] > odd[i]):
                texts[x] = made(i[x], j[x])
            yield pos[i], pos[j], track["start"][i], track["end"][j], planned, texts, chars, cps, cost

    return by_tracks(_table(words, lim), run, "track_id long, i long, j long, start double, end double, planned double, text string, chars int, cps double, cost double", NUMBERS)


class Segment(NamedTuple):
    """Words ``i`` to ``j`` shown from ``start`` to ``end``, for ``planned`` seconds if there is room."""

    i: int
    j: int
    start: float
    end: float
    planned: float
    cost: float
    text: str
    cps: float


class Path:
    """The partition of ``n`` words into runs of least total cost. Runs come by first word, then last; of each word only the best run that ends there is kept."""

    def __init__(self, n: int):
        self.best, self.last = [0.0] + [float("inf")] * n, [None] * (n + 1)

    def add(self, i: Iterable[int], j: Iterable[int], cost: Iterable[float], what: Iterable) -> None:
        best, last = self.best, self.last
        for a, b, c, x in zip(i, j, cost, what):
            if best[a] + c < best[b + 1]:
                best[b + 1], last[b + 1] = best[a] + c, (a, b, c, x)

    def found(self) -> list[tuple] | None:
        """(i, j, cost, what) in order, or None if the words cannot be cut."""
        out, at = [], len(self.best) - 1
        while at:
            if self.last[at] is None:
                return None
            out.append(self.last[at])
            at = self.last[at][0]
        return out[::-1]


def cheapest(n: int, runs) -> list[Segment] | None:
    """``Path`` over segments, or None."""
    runs, path = list(runs), Path(n)
    path.add((r.i for r in runs), (r.j for r in runs), (r.cost for r in runs), runs)
    found = path.found()
    return None if found is None else [r for *_, r in found]


def padded(segs: list[Segment], lim: Limits, sweeps: int = 4) -> list[Segment]:
    """Segments shorter than planned grow into the gaps beside them: half to the left, the rest to the right, then what is left over to the left."""
    segs = list(segs)
    for _ in range(sweeps):
        grown = False
        for k, s in enumerate(segs):
            need = max(lim.min_dur, s.planned) - (s.end - s.start)
            if need <= 1e-6:
                continue
            left = max(0.0, s.start - (segs[k - 1].end if k else 0.0))
            right = max(0.0, segs[k + 1].start - s.end) if k + 1 < len(segs) else max(need, 0.5)
            ahead = min(need - min(need / 2, left), right)
            back = min(need - ahead, left)
            if ahead > 0 or back > 0:
                segs[k], grown = s._replace(start=max(0.0, s.start - back), end=s.end + ahead), True
        if not grown:
            break
    return segs


def rendered(segs: list[Segment], tokens: list[str]) -> list[Segment]:
    """Texts made anew from the words, with the speed they are shown at."""
    out = []
    for s in segs:
        text = lexical.render(tokens[s.i : s.j + 1]) or s.text
        out.append(s._replace(text=text, cps=round(len(text) / max(1e-6, s.end - s.start), 3)))
    return out


def merged(segs: list[Segment], tokens: list[str], lim: Limits) -> list[Segment]:
    """Segments that break a limit join the next one, else the one before, where the whole keeps all limits."""

    def broken(s: Segment) -> bool:
        dur = s.end - s.start
        return dur <= 0 or dur < lim.min_dur - 1e-3 or len(s.text) / dur > lim.max_cps + 1e-3 or len(s.text) > lim.max_chars

    def whole(a: Segment, b: Segment) -> Segment | None:
        dur, text = b.end - a.start, lexical.render(tokens[a.i : b.j + 1])
        fits = 0 < dur <= lim.max_dur + 1e-6 and 0 < len(text) <= lim.max_chars
        if not fits or len(text) / max(dur, 1e-6) > lim.max_cps + 1e-3:
            return None
        return Segment(a.i, b.j, a.start, b.end, max(a.planned, b.planned), a.cost + b.cost, text, len(text) / max(dur, 1e-6))

    if len(segs) < 2:
        return list(segs)
    done, todo = [], deque(segs)
    while todo:
        s = todo.popleft()
        if broken(s):
            if todo and (m := whole(s, todo[0])):
                todo[0] = m
                continue
            if done and (m := whole(done[-1], s)):
                done.pop()
                todo.appendleft(m)
                continue
        done.append(s)
    return done


def finished(segs: list[Segment], tokens: list[str], lim: Limits) -> list[Segment]:
    """Padding, texts, merging, padding and texts again."""
    segs = rendered(padded(segs, lim), tokens)
    segs = merged(segs, tokens, lim)
    return rendered(padded(segs, lim), tokens)


def dp_segments(words: DataFrame, lim: Limits = Limits()) -> DataFrame:
    """Finished segments of every track; a track without a feasible partition gives no row, see ``track_status``.

    The runs of a track and their path are worked out beside its words, so that no table of runs is made.
    """

    def run(track: dict):
        words, tokens = track["word"], track["token"]
        made = lambda i, j: lexical.clean_py(" ".join(tokens[i : j + 1]))
        path = Path(len(words))
        for first in range(0, len(words), BLOCK):
            i, j, planned, _, _, cost = runs(track, lim, first, BLOCK, made)
            path.add(i.tolist(), j.tolist(), cost.tolist(), planned.tolist())
        start, end = track["start"], track["end"]
        segs = [Segment(i, j, float(start[i]), float(end[j]), planned, round(cost, 4), "", 0.0) for i, j, cost, planned in path.found() or []]
        segs = finished(segs, words, lim)
        return [(k, s.i, s.j, s.start, s.end, s.end - s.start, s.planned, len(s.text), s.cps, s.cost, s.text) for k, s in enumerate(segs, 1)]

    return by_tracks(_table(words, lim), in_rows(run), SCHEMA, NUMBERS)


def track_status(words: DataFrame, segments: DataFrame) -> DataFrame:
    """Per track: number of words and segments, seconds from the first word to the last, and ``ok`` or ``infeasible``."""
    return _status(words, segments.groupBy("track_id").agg(F.count("*").alias("n")))


def _status(words: DataFrame, counted: DataFrame, *keep: str) -> DataFrame:
    w = words.groupBy("track_id").agg(F.count("*").alias("word_count"), F.min_by("start_ms", "pos").alias("first"), F.max_by("end_ms", "pos").alias("last"))
    return w.join(counted, "track_id", "left").select("track_id", "word_count", F.coalesce("n", F.lit(0)).alias("segment_count"), F.bround((F.col("last") - F.col("first")) / 1000, 3).alias("total_duration"), F.when(F.col("n") > 0, "ok").otherwise("infeasible").alias("status"), *keep)


def reports(words: DataFrame, checked: DataFrame, lim: Limits = Limits()) -> DataFrame:
    """track_id and one JSON document: constraints, stats, validation, segments in order.

    ``checked`` are segments with the rules they break, ``found``; they are grouped once for all parts, for their path is costly.
    """
    one = F.struct("idx", "start", "end", "duration", "planned", "chars", "cps", "text", "word_start", "word_end", "cost", "found")
    segs = checked.groupBy("track_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(one)).alias("x"))
    segs = segs.select("track_id", "n", F.transform("x", lambda e: e.dropFields("found")).alias("segments"), F.flatten(F.transform("x", lambda e: F.transform(e["found"], lambda f: f["issue"]))).alias("issues"))
    rows = _status(words, segs, "segments", "issues")
    problems = F.coalesce("issues", F.array().cast("array<string>"))
    limits = F.struct(F.lit(lim.min_dur).alias("min_duration"), F.lit(lim.max_dur).alias("max_duration"), F.lit(lim.max_chars).alias("max_chars"), F.lit(lim.max_cps).alias("max_cps"), *[F.lit(True).alias(k) for k in ("single_line", "no_double_spaces", "no_en_em_dash")])
    document = F.struct(limits.alias("constraints"), F.struct("word_count", "segment_count", "total_duration").alias("stats"), F.struct((F.size(problems) == 0).alias("passed"), problems.alias("issues")).alias("validation"), "segments")
    return rows.select("track_id", F.to_json(document).alias("report"))
