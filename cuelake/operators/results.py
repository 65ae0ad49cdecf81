"""Cues with their results as finished captions: joined natively, then folded in order, one track per group.

A cue that asks to be joined goes into the caption before it, if that one has not grown too long; all others start no earlier
than the caption before them ends. Cues without a result keep their source text. The source text follows with the same times.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from .folding import by_tracks, in_rows
from .resegment import joined, tidy, width
from .timing import anchor_spans

SCHEMA = "track_id long, pos long, cue_id long, start_ms long, end_ms long, text string, source string"


@dataclass(frozen=True)
class Joins:
    """Limits of joining (ms, characters, cues) and of anchored times."""

    min_confidence: float = 0.0
    gap: int = 800
    chars: int = 28
    duration: int = 4000
    chain: int = 2
    anchors: bool = True
    least_ms: int = 220
    snap: int = 60

    @classmethod
    def checked(cls, **given) -> "Joins":
        """Values below the smallest that make sense are raised to it."""
        v = cls(**given)
        return replace(v, gap=max(0, v.gap), chars=max(8, v.chars), duration=max(500, v.duration), chain=max(1, v.chain), least_ms=max(80, v.least_ms), snap=max(0, v.snap))


class Counts(NamedTuple):
    """What happened to the cues of a track; a cue without result is missing, one whose result cannot be read is invalid."""

    revised: int = 0
    low_confidence: int = 0
    anchored: int = 0
    overlaps: int = 0
    joined: int = 0
    blocked: int = 0
    missing: int = 0
    invalid: int = 0
    total: int = 0
    output: int = 0


class Row(NamedTuple):
    cue_id: int
    start: int
    end: int
    cue_end: int
    text: str
    source: str
    join: bool


class Caption(NamedTuple):
    cue_id: int
    start: int
    end: int
    text: str
    source: str
    cues: int


def _marked(text: str) -> tuple[str, str]:
    core = re.sub(r"[\s*]+\Z", "", text)
    return core, "*" if "*" in text[len(core) :] else ""


def grown(last: Caption, row: Row, lim: Joins) -> Caption | None:
    """The caption with the row in it, or None if it would break a limit."""
    (a, m), (b, n) = _marked(last.text), _marked(row.text)
    text, end = joined(a, b).strip(), max(last.end, row.end)
    text += (m or n) if text else ""
    if end - last.start > lim.duration or width(text) > lim.chars or last.cues >= lim.chain:
        return None
    return Caption(last.cue_id, last.start, end, text, joined(last.source, row.source), last.cues + 1)


def fold(rows: list[Row], lim: Joins, seen: Counter | None = None) -> list[Caption]:
    """Captions of a track; ``seen`` counts cues joined, joins that a limit blocked, and starts moved out of an overlap."""
    out: list[Caption] = []
    seen = Counter() if seen is None else seen
    for r in rows:
        start, end, text = r.start, r.end, r.text
        if out:
            last = out[-1]
            if lim.snap > 0 and abs(start - last.end) <= lim.snap:
                start = last.end
            if r.join and 0 <= start - last.end <= lim.gap:
                if (more := grown(last, r, lim)) is not None:
                    out[-1] = more
                    seen["joined"] += 1
                    continue
                seen["blocked"] += 1
                text = re.sub(r"\A[，,]\s*", "", text)
            seen["overlaps"] += start < last.end
            start = max(start, last.end)
            if end <= start:
                end = max(start + 1, min(r.cue_end, start + max(1, lim.least_ms)))
        out.append(Caption(r.cue_id, start, end, text, r.source, 1))
    return out


def _prepared(cues: DataFrame, results: DataFrame, lim: Joins) -> DataFrame:
    """Cues with their results and anchored times. A column ``valid`` of the results, if there, says whether one could be read."""
    found = results.withColumn("valid", F.col("valid") if "valid" in results.columns else F.lit(True)).select("track_id", "cue_id", "revised_zh", "confidence", "join_with_prev", "has_anchor", "anchor_start_ratio", "anchor_end_ratio", "valid")
    rows = cues.select("track_id", "pos", "cue_id", "start_ms", "end_ms", F.col("end_ms").alias("cue_end"), "text").join(found, ["track_id", "cue_id"], "left")
    good = F.coalesce("valid", F.lit(False))
    rows = rows.withColumns({"missing": F.col("valid").isNull(), "invalid": ~F.coalesce("valid", F.lit(True)), "revised_zh": F.when(good, F.col("revised_zh"))})
    rows = rows.withColumns({"low": good & F.coalesce(F.col("confidence") < lim.min_confidence, F.lit(False)), "joins": good & F.coalesce("join_with_prev", F.lit(False)), "has_anchor": good & F.coalesce("has_anchor", F.lit(False))})
    return anchor_spans(rows, lim.least_ms, lim.anchors, keep=("pos", "cue_end", "text", "revised_zh", "low", "joins", "missing", "invalid"))


def _given(track: dict) -> list[Row]:
    out = []
    for i, start, end, cue_end, source, revised, low, joins in zip(*(track[c] for c in ("cue_id", "start_ms", "end_ms", "cue_end", "text", "revised_zh", "low", "joins"))):
        source, revised = source or "", tidy(revised.strip()) if revised else ""
        out.append(Row(i, start, end, cue_end, revised + "*" * bool(low) if revised else source, source, bool(joins)))
    return out


def merge_results(cues: DataFrame, results: DataFrame, lim: Joins | None = None) -> DataFrame:
    """Captions of every track. ``results`` has one row per (track_id, cue_id): revised_zh, confidence, join_with_prev and anchors."""
    lim = lim or Joins()

    def run(track: dict):
        return ((i, *c[:5]) for i, c in enumerate(fold(_given(track), lim)))

    return by_tracks(_prepared(cues, results, lim), in_rows(run), SCHEMA)


def merge_counts(cues: DataFrame, results: DataFrame, lim: Joins | None = None) -> DataFrame:
    """``Counts`` of every track."""
    lim = lim or Joins()

    def run(track: dict):
        seen, rows = Counter(), _given(track)
        out = fold(rows, lim, seen)
        revised = sum(bool(x and x.strip()) for x in track["revised_zh"])
        return [Counts(revised, sum(track["low"]), sum(track["anchored"]), seen["overlaps"], seen["joined"], seen["blocked"], sum(track["missing"]), sum(track["invalid"]), len(rows), len(out))]

    return by_tracks(_prepared(cues, results, lim), in_rows(run), "track_id long, " + ", ".join(f"{f} long" for f in Counts._fields))
