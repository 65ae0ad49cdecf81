"""Runs of a revision backend over tracks: window by window with carried history, cue by cue, and the refining pass.

A backend answers requests; ``MockBackend`` is the one built in. Windows of a track depend on what earlier windows gave, so
a track is one group; cues by themselves are independent rows. Statuses are ok, fail and skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import islice
from typing import NamedTuple, Protocol

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..shipping import ship_package
from .folding import by_tracks, in_rows
from .resegment import tidy
from .track import by_track, serial_windows


class Cue(NamedTuple):
    cue_id: int
    start_ms: int
    end_ms: int
    text: str
    existing: str | None = None


class Answer(NamedTuple):
    """Of one cue; ``prev`` is a new text of the cue before, in the refining pass only."""

    cue_id: int
    text: str
    confidence: float | None = None
    join_with_prev: bool = False
    prev: str | None = None


class Backend(Protocol):
    """Pickled to the workers. Raising, or leaving a cue out, fails that window or cue. ``raw``: texts stand as they are."""

    raw: bool

    def window(self, history: list[tuple[Cue, str]], window: list[tuple[Cue, str]], lookahead: list[Cue]) -> Iterable[Answer]: ...

    def cue(self, cue: Cue) -> Answer: ...

    def refine(self, prev: Cue | None, current: Cue, following: Cue | None, sources: tuple[str, str, str]) -> Answer: ...


class MockBackend:
    """The source text with a mark; refining changes nothing. Its texts are not tidied."""

    raw = True

    def window(self, history, window, lookahead):
        return [Answer(c.cue_id, f"[MOCK] {c.text}", 1.0) for c, _ in window]

    def cue(self, cue):
        return Answer(cue.cue_id, f"[MOCK] {cue.text}", 1.0)

    def refine(self, prev, current, following, sources):
        return Answer(current.cue_id, current.text, 1.0)


@dataclass(frozen=True)
class Serial:
    """``confidence``: where an answer has none. ``needs_text``: an empty answer fails, else it keeps the earlier text."""

    size: int = 3
    overlap: int = 1
    history: int = 6
    force: bool = False
    confidence: float = 0.5
    needs_text: bool = False
    joins: bool = True


class Done(NamedTuple):
    text: str | None
    confidence: float | None
    join: bool | None
    status: str


def serial_track(cues: list[Cue], backend: Backend, how: Serial) -> dict[int, Done]:
    """Windows in order: a window runs if any of its cues has no result (then all of it), and an ok is never taken back."""
    step = max(1, how.size - min(how.overlap, how.size - 1))
    now = {c.cue_id: tidy(c.existing) for c in cues if c.existing and c.existing.strip()}
    done: dict[int, Done] = {}
    for i in range(0, len(cues), step):
        window = cues[i : i + how.size]
        if not how.force and all(c.existing is not None for c in window):
            for c in window:
                done.setdefault(c.cue_id, Done(c.existing, None, None, "skipped"))
            continue
        past = list(islice(((c, now[c.cue_id]) for c in (cues[p] for p in range(i - 1, -1, -1)) if now.get(c.cue_id, "").strip()), how.history))[::-1] if how.history > 0 else []
        try:
            answers = {a.cue_id: a for a in backend.window(past, [(c, now.get(c.cue_id, "")) for c in window], cues[i + len(window) : i + len(window) + 2])}
        except Exception:  # whatever a backend raises fails its window only
            answers = {}
        for c in window:
            a = answers.get(c.cue_id)
            text = "" if a is None else a.text if getattr(backend, "raw", False) else tidy(a.text)
            if a is None or (how.needs_text and not text):
                done.setdefault(c.cue_id, Done(c.existing, None, None, "fail"))
                continue
            now[c.cue_id] = text or now.get(c.cue_id, "")
            done[c.cue_id] = Done(now[c.cue_id], how.confidence if a.confidence is None else a.confidence, a.join_with_prev if how.joins else None, "ok")
    return done


_DONE = "track_id long, cue_id long, revised_zh string, confidence double, join_with_prev boolean, status string"


def _cues(track: dict) -> list[Cue]:
    return [Cue(i, s, e, t or "", x) for i, s, e, t, x in zip(track["cue_id"], track["start_ms"], track["end_ms"], track["text"], track.get("existing") or [None] * len(track["cue_id"]))]


def serial_run(cues: DataFrame, existing: DataFrame | None = None, backend: Backend | None = None, how: Serial = Serial()) -> DataFrame:
    """One row per cue: its result and status. ``existing`` (track_id, cue_id, revised_zh): results of an earlier run."""
    backend = backend or MockBackend()
    rows = cues.select("track_id", "pos", "cue_id", "start_ms", "end_ms", "text")
    if existing is not None:
        rows = rows.join(existing.select("track_id", "cue_id", F.col("revised_zh").alias("existing")), ["track_id", "cue_id"], "left")

    def run(track: dict):
        return ((k, *d) for k, d in serial_track(_cues(track), backend, how).items())

    return by_tracks(rows, in_rows(run), _DONE)


def cue_run(cues: DataFrame, backend: Backend | None = None) -> DataFrame:
    """Every cue by itself, in any order; an answer without text is still ok."""
    ship_package(cues.sparkSession)
    backend = backend or MockBackend()

    def one(c: Cue) -> tuple:
        try:
            a = backend.cue(c)
        except Exception:  # whatever a backend raises fails its cue only
            return c.cue_id, None, None, None, "fail"
        return c.cue_id, a.text, a.confidence, a.join_with_prev, "ok"

    def run(batches):
        for pdf in batches:
            rows = [(t, *one(Cue(int(i), int(s), int(e), x or ""))) for t, i, s, e, x in zip(pdf.track_id, pdf.cue_id, pdf.start_ms, pdf.end_ms, pdf.text)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _DONE.split(", ")])

    return cues.select("track_id", "cue_id", "start_ms", "end_ms", "text").mapInPandas(run, _DONE)


def status_counts(done: DataFrame) -> DataFrame:
    """Per track: cues ok, failed, skipped, and all."""
    is_ = lambda s: F.count_if(F.col("status") == s).alias(s)
    return done.groupBy("track_id").agg(is_("ok"), is_("fail"), is_("skipped"), F.count("*").alias("total"))


def history_lookahead(cues: DataFrame, results: DataFrame, size: int, overlap: int, history: int = 6, ahead: int = 2) -> DataFrame:
    """Per window: ids of the last ``history`` cues before it that have a text, and of the ``ahead`` cues behind it, as arrays in order.

    Cues with a text are numbered, so each window asks for the numbers before its own start by an equi-join.
    """
    step = max(1, size - min(overlap, size - 1))
    rows = cues.select("track_id", "pos", "cue_id").join(results.select("track_id", "cue_id", "revised_zh"), ["track_id", "cue_id"], "left")
    has = F.coalesce(F.length(F.trim("revised_zh")) > 0, F.lit(False))
    nth = F.sum(has.cast("long")).over(W.partitionBy("track_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumns({"has": has, "nth": nth})
    starts = rows.where(F.col("pos") % step == 0).select("track_id", (F.col("pos") / step).cast("long").alias("win"), (F.col("nth") - F.col("has").cast("long")).alias("before"), (F.col("pos") + size).alias("behind"))
    told = rows.where("has").select("track_id", "nth", F.col("cue_id").alias("h"))
    past = starts.where("before > 0").select("track_id", "win", F.explode(F.sequence(F.greatest(F.lit(1), F.col("before") - history + 1), F.col("before"))).alias("nth")).join(told, ["track_id", "nth"])
    past = past.groupBy("track_id", "win").agg(F.sort_array(F.collect_list(F.struct("nth", "h"))).alias("x")).select("track_id", "win", F.transform("x", lambda e: e["h"]).alias("history"))
    nxt = starts.select("track_id", "win", F.explode(F.sequence(F.col("behind"), F.col("behind") + ahead - 1)).alias("pos")).join(rows.select("track_id", "pos", "cue_id"), ["track_id", "pos"])
    nxt = nxt.groupBy("track_id", "win").agg(F.sort_array(F.collect_list(F.struct("pos", "cue_id"))).alias("x")).select("track_id", "win", F.transform("x", lambda e: e["cue_id"]).alias("lookahead"))
    none = F.array().cast("array<long>")
    out = starts.select("track_id", "win").join(past, ["track_id", "win"], "left").join(nxt, ["track_id", "win"], "left")
    return out.select("track_id", "win", F.coalesce("history", none).alias("history"), F.coalesce("lookahead", none).alias("lookahead"))


def source_of(cues: DataFrame, sources: DataFrame) -> DataFrame:
    """track_id, pos, source: the source cue of the same id (the last, if it repeats), else that of the same position, else empty."""
    by_id = sources.groupBy("track_id", "cue_id").agg(F.max_by("text", "pos").alias("by_id"))
    by_pos = sources.select("track_id", "pos", F.col("text").alias("by_pos"))
    rows = cues.join(by_id, ["track_id", "cue_id"], "left").join(by_pos, ["track_id", "pos"], "left")
    return rows.select("track_id", "pos", "cue_id", F.coalesce("by_id", "by_pos", F.lit("")).alias("source"))


class Refined(NamedTuple):
    processed: int = 0
    updated_current: int = 0
    updated_prev: int = 0
    failed: int = 0
    out_of_range: int = 0


def refine_track(cues: list[Cue], sources: list[str], backend: Backend, start_id: int = 0, end_id: int = 0, limit: int = 0, checkpoint: Callable[[list[Cue], int], None] | None = None, every: int = 20) -> tuple[list[Cue], Refined]:
    """Cues in order, each seeing what refining has made of the one before; 0 is no bound. ``checkpoint`` is told every ``every`` cues and at the end."""
    out, n = list(cues), Refined()
    around = lambda xs, k: xs[k] if 0 <= k < len(xs) else None
    for k, c in enumerate(cues):
        if (start_id and c.cue_id < start_id) or (end_id and c.cue_id > end_id):
            n = n._replace(out_of_range=n.out_of_range + 1)
            continue
        if limit and n.processed >= limit:
            break
        n = n._replace(processed=n.processed + 1)
        try:
            a = backend.refine(around(out, k - 1), out[k], around(out, k + 1), tuple(around(sources, j) or "" for j in (k - 1, k, k + 1)))
            if a.cue_id != c.cue_id:
                raise ValueError("answer for another cue")
        except Exception:  # whatever a backend raises fails its cue only
            n = n._replace(failed=n.failed + 1)
        else:
            text, prev = tidy(a.text), tidy(a.prev or "")
            if text and text != out[k].text:
                out[k], n = out[k]._replace(text=text), n._replace(updated_current=n.updated_current + 1)
            if prev and k and prev != out[k - 1].text:
                out[k - 1], n = out[k - 1]._replace(text=prev), n._replace(updated_prev=n.updated_prev + 1)
        if checkpoint and every > 0 and n.processed % every == 0:
            checkpoint(out, n.processed)
    if checkpoint:
        checkpoint(out, n.processed)
    return out, n


def refine(cues: DataFrame, sources: DataFrame, backend: Backend | None = None, start_id: int = 0, end_id: int = 0, limit: int = 0) -> DataFrame:
    """Refined cues of every track, with the track's counters on each row. Texts are tidied before."""
    backend = backend or MockBackend()
    rows = cues.select("track_id", "pos", "cue_id", "start_ms", "end_ms", "text").join(source_of(cues, sources).select("track_id", "pos", "source"), ["track_id", "pos"])
    schema = "track_id long, pos long, cue_id long, start_ms long, end_ms long, text string, " + ", ".join(f"{f} long" for f in Refined._fields)

    def run(track: dict):
        given = [c._replace(text=tidy(c.text)) for c in _cues(track)]
        out, n = refine_track(given, track["source"], backend, start_id, end_id, limit)
        return ((p, *c[:4], *n) for p, c in zip(track["pos"], out))

    return by_tracks(rows, in_rows(run), schema)


def window_images(cues: DataFrame, images: DataFrame, size: int, overlap: int) -> DataFrame:
    """(track_id, win, images): all images of a window's cues, each once. images: (track_id, cue_id, slot)."""
    rows = serial_windows(cues, size, overlap).join(cues.select("track_id", "pos", "cue_id"), ["track_id", "pos"]).join(images, ["track_id", "cue_id"])
    return rows.groupBy("track_id", "win").agg(F.array_join(F.sort_array(F.collect_set(F.format_string("%06d/%s", "cue_id", "slot"))), ",").alias("images"))


def prepare_counts(cues: DataFrame, start: int, end: int, limit: int) -> DataFrame:
    """Per track: all cues, those prepared, and those skipped for their duration before the limit was reached; 0 is no bound."""
    ok = (F.col("cue_id") >= start) & ((F.col("cue_id") <= end) | F.lit(end == 0))
    good = ok & (F.col("end_ms") > F.col("start_ms"))
    before = F.coalesce(F.sum(good.cast("long")).over(by_track().rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = cues.withColumns({"good": good, "bad": ok & ~good, "open": (before < limit) | F.lit(limit == 0)})
    return rows.groupBy("track_id").agg(F.count("*").alias("total"), F.count_if(F.col("good") & F.col("open")).alias("prepared"), F.count_if(F.col("bad") & F.col("open")).alias("skipped"))
