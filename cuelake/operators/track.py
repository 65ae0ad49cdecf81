"""Operators over caption tracks: context, windows, joins, sessions, frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.text import strip, tidy


def by_track():
    """Rows of a track in order."""
    return W.partitionBy("track_id").orderBy("pos")


def neighbour_text(cues: DataFrame) -> DataFrame:
    near = lambda f: F.coalesce(f("text").over(by_track()), F.lit(""))
    return cues.select("track_id", "pos", near(F.lag).alias("prev_text"), near(F.lead).alias("next_text"))


def select_cues(cues: DataFrame, start: int, end: int, limit: int) -> DataFrame:
    """Id range, then the first ``limit`` cues of positive duration of each track; 0 is no bound."""
    rows = cues.where((F.col("cue_id") >= start) & ((F.col("cue_id") <= end) | F.lit(end == 0)) & (F.col("end_ms") > F.col("start_ms")))
    return rows.withColumn("n", F.row_number().over(by_track())).where((F.col("n") <= limit) | F.lit(limit == 0)).drop("n")


def serial_windows(cues: DataFrame, size: int, overlap: int) -> DataFrame:
    """(track_id, win, pos): windows of ``size`` rows each starting ``size - overlap`` after the last, while a start exists."""
    step = max(1, size - min(overlap, size - 1))
    last = F.floor(F.col("pos") / step)
    first = F.greatest(F.lit(0), F.floor((F.col("pos") - size) / step) + 1)
    return cues.select("track_id", F.explode(F.sequence(first, last)).alias("win"), "pos")


def word_clamp(words: DataFrame, longest: int = 6950) -> DataFrame:
    """End times capped at ``longest`` ms after the start and 1 ms before the next word, where that leaves a duration."""
    nxt = F.lead("start_ms").over(by_track())
    want = F.when(F.col("end_ms") <= F.col("start_ms"), F.col("start_ms") + 50).otherwise(F.least(F.col("end_ms"), F.col("start_ms") + longest))
    capped = F.when(nxt.isNotNull(), F.least(want, nxt - 1)).otherwise(want)
    return words.select("track_id", "pos", "start_ms", F.when(capped > F.col("start_ms"), capped).otherwise(F.col("end_ms")).alias("end_ms"))


def sessions(points: DataFrame, key: str, t: str, gap: float) -> DataFrame:
    """Gaps and islands: a new session where the step to the previous point is over ``gap``, strictly."""
    w = W.partitionBy(key).orderBy(t)
    rows = points.withColumn("new", F.when(F.col(t) - F.lag(t).over(w) > gap, 1).otherwise(0))
    return rows.withColumn("session", F.sum("new").over(w.rangeBetween(W.unboundedPreceding, 0))).drop("new")


def person_area(detections: DataFrame, image_area: int, threshold: float) -> DataFrame:
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    g = detections.groupBy("frame_id").agg(F.coalesce(F.sum(F.when(F.col("cls") == "person", area)), F.lit(0)).cast("long").alias("area"), F.count_if(F.col("cls") == "person").alias("person_count"), F.count_if(F.col("cls") != "person").alias("non_person_count"))
    ratio = F.col("area") / max(1, image_area)
    return g.select("frame_id", "person_count", "non_person_count", F.round(ratio, 4).alias("ratio"), (ratio > threshold).alias("discard"))


def detection_list(detections: DataFrame, image_area: int) -> DataFrame:
    """Per frame, its detections in order: class, confidence to three places, share of the image to four. detections have ``det`` (order) and ``conf``."""
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    one = F.struct("det", "cls", F.bround("conf", 3).alias("conf"), F.bround(area / max(1, image_area), 4).alias("area_ratio"))
    return detections.groupBy("frame_id").agg(F.transform(F.sort_array(F.collect_list(one)), lambda x: x.dropFields("det")).alias("detections"))


def frame_totals(verdicts: DataFrame, threshold: float) -> DataFrame:
    """One row: all frames, kept, discarded, and the threshold."""
    return verdicts.agg(F.count("*").alias("total"), F.count_if(~F.col("discard")).alias("kept"), F.count_if("discard").alias("discarded"), F.lit(threshold).alias("threshold"))


def split_frames(frames: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Frames with ``skipped``: true keeps a frame aside instead of deleting it; a frame without detections stays."""
    return frames.join(verdicts.select("frame_id", "discard"), "frame_id", "left").select("*", F.coalesce("discard", F.lit(False)).alias("skipped")).drop("discard")


def frame_targets(cues: DataFrame, pad: int = 100, short: int = 400, short_pad: int = 30) -> DataFrame:
    """Sample points of cues, in ms: by their column ``mode`` none, mid or three; three without it.

    If padding crosses over, the middle three times; a cue that does not last, its start three times.
    """
    lo, hi = F.col("start_ms"), F.col("end_ms")
    p = F.when(hi - lo < short, short_pad).otherwise(pad)
    t0, t2 = F.least(hi, lo + p), F.greatest(lo, hi - p)
    mid = (lo + hi) / 2
    pick = lambda t: F.when(hi <= lo, lo.cast("double")).when(t0 > t2, mid).otherwise(t.cast("double"))
    slots = F.array(*[F.struct(F.lit(n).alias("slot"), pick(t).alias("t_ms")) for n, t in (("start", t0), ("mid", mid), ("end", t2))])
    if "mode" in cues.columns:
        slots = F.when(F.col("mode") == "none", F.filter(slots, lambda x: F.lit(False))).when(F.col("mode") == "mid", F.filter(slots, lambda x: x["slot"] == "mid")).otherwise(slots)
    return cues.select("track_id", "cue_id", F.explode(slots).alias("s")).select("track_id", "cue_id", "s.slot", "s.t_ms")


def missing_frames(targets: DataFrame, existing: DataFrame) -> DataFrame:
    """Targets whose frame is not there yet."""
    return targets.join(existing.select("track_id", "cue_id", "slot"), ["track_id", "cue_id", "slot"], "left_anti")


def frame_indices(points: DataFrame, fps: float, n_frames: int) -> DataFrame:
    """Requests grouped by the frame they fall on, within a session read from 1 s before its first: track_id, session, frame, n.

    points: (track_id, session, t_sec). What lies behind the last frame gets the last one.
    """
    seek = F.greatest(F.lit(0.0), F.min("t_sec").over(W.partitionBy("track_id", "session")) - 1.0)
    index = F.greatest(F.lit(0), F.bround((F.col("t_sec") - F.col("seek")) * fps).cast("long"))
    rows = points.withColumn("seek", seek).select("track_id", "session", F.least(F.lit(n_frames - 1), index).cast("long").alias("frame"))
    return rows.groupBy("track_id", "session", "frame").agg(F.count("*").alias("n"))


def punctuation_blocks(words: DataFrame, size: int = 180) -> DataFrame:
    """(track_id, block, n_words, text): words in blocks, each without punctuation at its ends unless that leaves nothing."""
    bare = F.regexp_replace("word", "(?U)^[^\\w']+|[^\\w']+$", "")
    rows = words.select("track_id", F.floor(F.col("pos") / size).alias("block"), "pos", F.when(bare != "", bare).otherwise(F.col("word")).alias("w"))
    g = rows.groupBy("track_id", "block").agg(F.count("*").alias("n_words"), F.sort_array(F.collect_list(F.struct("pos", "w"))).alias("x"))
    return g.select("track_id", "block", "n_words", F.array_join(F.transform("x", lambda e: e["w"]), " ").alias("text"))


def punctuated(words: DataFrame, restored: DataFrame, size: int = 180) -> DataFrame:
    """Words with the tokens of restored blocks (track_id, block, text); a block of another number of tokens is left as it was."""
    n = words.groupBy("track_id", F.floor(F.col("pos") / size).alias("block")).agg(F.count("*").alias("n"))
    tokens = restored.select("track_id", "block", F.filter(F.split("text", "(?U)\\s+"), lambda x: x != "").alias("tokens")).join(n, ["track_id", "block"]).where(F.size("tokens") == F.col("n")).select("track_id", "block", "tokens")
    rows = words.withColumn("block", F.floor(F.col("pos") / size)).join(tokens, ["track_id", "block"], "left")
    return rows.withColumn("word", F.coalesce(F.get("tokens", (F.col("pos") % size).cast("int")), "word")).drop("block", "tokens")


def mock_results(cues: DataFrame) -> DataFrame:
    return cues.select("track_id", "cue_id", F.concat(F.lit("[MOCK] "), "text").alias("revised_zh"), F.lit(1.0).alias("confidence"), F.lit(False).alias("join_with_prev"))


def merge_left(cues: DataFrame, results: DataFrame, min_confidence: float) -> DataFrame:
    """Cues with their revision, tidied; a missing or empty one keeps the source text, low confidence marks a revision by a star."""
    j = cues.join(results, ["track_id", "cue_id"], "left")
    text = tidy(F.col("revised_zh"))
    revised = F.when(strip(F.col("revised_zh")) != "", F.concat(text, F.when(F.col("confidence") < min_confidence, "*").otherwise("")))
    return j.select("track_id", "cue_id", F.coalesce(revised, "text").alias("text"), F.col("revised_zh").isNull().alias("missing"))


def result_defaults(results: DataFrame, confidence: float = 0.5, joins: bool = True, needs_text: bool = False) -> DataFrame:
    """Answers with what they lack: confidence, joining; an answer without text fails, or takes ``earlier``."""
    text = strip(F.coalesce("revised_zh", F.lit("")))
    given = F.when(text != "", text)
    out = results.withColumn("status", F.when(given.isNull() & F.lit(needs_text), "fail").otherwise("ok"))
    join = F.coalesce("join_with_prev", F.lit(False)) if joins else F.lit(None).cast("boolean")
    return out.select("track_id", "cue_id", F.coalesce(given, F.lit(None) if needs_text else F.coalesce("earlier", F.lit(""))).alias("revised_zh"), F.coalesce("confidence", F.lit(confidence)).alias("confidence"), join.alias("join_with_prev"), "status")
