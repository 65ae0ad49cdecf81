"""Anchored cue times, frame choice and limits of finished segments, as row expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import two_places


def ratio(value: Column, default: float) -> Column:
    """A number or numeric string within 0 and 1; anything else, infinities and NaN give ``default``."""
    x = value.try_cast("double")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(F.isnan(x) | (F.abs(x) == float("inf")), default).otherwise(F.coalesce(x, F.lit(default)))))


def anchor_spans(rows: DataFrame, min_ms: int = 0, use: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """track_id, cue_id, start_ms, end_ms, anchored of cues with ``has_anchor``, ``anchor_start_ratio`` and ``anchor_end_ratio``.

    A span shorter than ``min_ms`` takes half of what it lacks from its left, the rest from its right, and what the right
    side of the cue cannot give from the left again. Cues of up to 1 ms and cues without anchor keep their times. Columns in ``keep`` stay.
    """
    lo, hi = F.col("start_ms"), F.col("end_ms")
    a, b = ratio(F.col("anchor_start_ratio"), 0.0), ratio(F.col("anchor_end_ratio"), 1.0)
    at = lambda r: lo + F.rint((hi - lo) * r).cast("long")
    rows = rows.select("track_id", "cue_id", *keep, lo, hi, (F.lit(use) & F.coalesce("has_anchor", F.lit(False)) & (hi - lo > 1)).alias("anchored"), at(F.least(a, b)).alias("s"), at(F.greatest(a, b)).alias("e"))
    rows = rows.withColumn("s", F.greatest(lo, F.least(F.col("s"), hi - 1)))
    rows = rows.withColumn("e", F.greatest(F.col("s") + 1, F.least(F.col("e"), hi)))
    lack = F.greatest(F.lit(0), F.lit(min_ms) - (F.col("e") - F.col("s")))
    rows = rows.withColumn("lack", lack if min_ms > 1 else F.lit(0))
    right = F.least(hi - F.col("e"), F.col("lack") - F.least(F.col("s") - lo, F.floor(F.col("lack") / 2)))
    rows = rows.withColumn("right", right)
    left = F.least(F.col("s") - lo, F.col("lack") - F.col("right"))
    pick = lambda own, anchored: F.when(F.col("anchored"), anchored).otherwise(own)
    return rows.select("track_id", "cue_id", *keep, pick(lo, F.col("s") - left).alias("start_ms"), pick(hi, F.col("e") + F.col("right")).alias("end_ms"), "anchored")


def frame_mode(cues: DataFrame, mode: str, mid_up_to_sec: float) -> DataFrame:
    """``adaptive``: one middle frame for cues up to the limit, three for longer ones; any other mode holds for all."""
    mode = mode.strip().lower()
    short = (F.col("end_ms") - F.col("start_ms")) / 1000 <= max(0.0, mid_up_to_sec)
    return cues.select("track_id", "cue_id", (F.when(short, "mid").otherwise("three") if mode == "adaptive" else F.lit(mode)).alias("mode"))


def image_policy(cues: DataFrame, frames: DataFrame, policy: str) -> DataFrame:
    """track_id, cue_id, images (slots in order), reason (null where the policy is met).

    ``frames`` has the existing (track_id, cue_id, slot). ``rand1`` picks by a hash of the ids, so that a rerun picks alike.
    """
    policy = policy.strip().lower()
    there = frames.groupBy("track_id", "cue_id").agg(F.collect_set("slot").alias("there"))
    slots = F.array(*map(F.lit, ("start", "mid", "end")))
    rows = cues.select("track_id", "cue_id").join(there, ["track_id", "cue_id"], "left")
    rows = rows.withColumn("have", F.filter(slots, lambda s: F.array_contains(F.coalesce("there", F.array().cast("array<string>")), s)))
    have, none = F.col("have"), F.array().cast("array<string>")
    if policy == "none":
        images = none
    elif policy == "mid":
        images = F.filter(have, lambda s: s == "mid")
    elif policy == "three":
        images = F.when(F.size(have) == 3, have).otherwise(none)
    elif policy == "rand1":
        images = F.slice(have, F.pmod(F.xxhash64("track_id", "cue_id"), F.greatest(F.size(have), F.lit(1))).cast("int") + 1, 1)
    else:
        images = have
    reason = F.when(F.size(images) == 0, f"missing_{policy}") if policy in ("mid", "three") else F.lit(None).cast("string")
    return rows.select("track_id", "cue_id", F.array_join(images, ",").alias("images"), reason.alias("reason"))


def segment_limits(segments: DataFrame, min_sec: float = 5 / 6, max_cps: float = 20.0, max_chars: int = 42) -> DataFrame:
    """track_id, cue_id, needs_fix (duration, reading speed or length out of bounds) and plain_text (one clean line)."""
    sec, n = (F.col("end_ms") - F.col("start_ms")) / 1000, F.length("text")
    bad = (sec <= 0) | (sec < min_sec - 1e-3) | (n > max_chars) | (n / F.greatest(sec, F.lit(1e-9)) > max_cps + 1e-3)
    plain = ~F.col("text").rlike("\n|  |[–—]") & (n <= max_chars)
    return segments.select("track_id", "cue_id", bad.alias("needs_fix"), plain.alias("plain_text"))


def last_responses(items: DataFrame, responses: DataFrame) -> DataFrame:
    """Window items with the last response to each, by ``item_pos``; ids that the window lacks are ignored."""
    last = responses.groupBy("track_id", "win", "cue_id").agg(F.max_by("revised_zh", "item_pos").alias("revised_zh"))
    out = items.select("track_id", "win", "cue_id").join(last.withColumn("hit", F.lit(True)), ["track_id", "win", "cue_id"], "left")
    return out.select("track_id", "win", "cue_id", "revised_zh", F.when(F.col("hit"), "ok").otherwise("fail").alias("status"))


def broken_rules(segments: DataFrame, min_sec: float = 5 / 6, max_sec: float = 7.0, max_chars: int = 42, max_cps: float = 20.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """track_id, pos, the columns of ``keep``, and ``found``: number and issue of each rule the segment breaks, in order."""
    text, sec = F.coalesce("text", F.lit("")), (F.col("end_ms") - F.col("start_ms")) / 1000
    n = F.length(text)
    cps = F.when(sec > 0, n / sec).otherwise(float("inf"))
    before = F.lag("end_ms").over(Window.partitionBy("track_id").orderBy("pos"))
    rules = [
        ((sec < min_sec - 1e-3) | (sec > max_sec + 1e-3), F.format_string(f"duration %.3fs out of [{min_sec:.3f}, {max_sec:.3f}]", sec)),
        (text.contains("\n"), F.lit("contains newline (must be single-line)")),
        (n > max_chars, F.format_string(f"chars %d > {max_chars}", n)),
        (cps > max_cps + 1e-3, F.when(sec > 0, F.concat(F.lit("cps "), two_places(cps), F.lit(f" > {max_cps:.2f}"))).otherwise(f"cps inf > {max_cps:.2f}")),
        (text.contains("  "), F.lit("contains double spaces")),
        (text.rlike("[–—]"), F.lit("contains en/em dash")),
        (F.col("start_ms") < before, F.lit("overlaps previous cue")),
    ]
    found = [F.when(bad, F.struct(F.lit(i).alias("rule"), said.alias("issue"))) for i, (bad, said) in enumerate(rules, 1)]
    return segments.select("track_id", "pos", *keep, F.filter(F.array(*found), lambda x: x.isNotNull()).alias("found"))


def validation_report(segments: DataFrame, **limits: float) -> DataFrame:
    """track_id, pos, rule, issue: one row per broken rule, rules numbered in the order they are reported."""
    return broken_rules(segments, **limits).select("track_id", "pos", F.inline("found"))
