"""Prompt texts as Columns: the data of a cue and its neighbours in fixed lines, with short instructions of our own."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import clip, ms_to_ts

NONE = "- <none>"


def _id(c: Column) -> Column:
    return c.cast("string")


def span(start: Column, end: Column) -> Column:
    return F.concat(F.lit("["), ms_to_ts(start), F.lit(" --> "), ms_to_ts(end), F.lit("]"))


def context_line(label: str, cue_id: Column, start: Column, end: Column, text: Column) -> Column:
    """One neighbour; null where there is none."""
    return F.when(cue_id.isNotNull(), F.concat(F.lit(f"- {label} cue "), _id(cue_id), F.lit(" "), span(start, end), F.lit(": "), F.coalesce(text, F.lit(""))))


def two_lines(head: Column, second: str, en: Column, zh: Column, n: int) -> Column:
    """A cue with its source and its translation, both clipped."""
    return F.concat(head, F.lit("\n  EN: "), clip(F.coalesce(en, F.lit("")), n), F.lit(f"\n  {second}: "), clip(F.coalesce(zh, F.lit("")), n))


def history_line(cue_id: Column, start: Column, end: Column, en: Column, zh: Column) -> Column:
    return two_lines(F.concat(F.lit("- cue "), _id(cue_id), F.lit(" "), span(start, end)), "ZH", en, zh, 180)


def window_line(cue_id: Column, start: Column, end: Column, en: Column, zh: Column) -> Column:
    return two_lines(F.concat(F.lit("- cue "), _id(cue_id), F.lit(" "), span(start, end)), "current_zh", en, zh, 220)


def lookahead_line(cue_id: Column, start: Column, end: Column, en: Column) -> Column:
    return F.concat(F.lit("- cue "), _id(cue_id), F.lit(" "), span(start, end), F.lit(": "), clip(F.coalesce(en, F.lit("")), 180))


def refine_line(label: str, cue_id: Column, start: Column, end: Column, en: Column, zh: Column) -> Column:
    line = two_lines(F.concat(F.lit(f"- {label} cue "), _id(cue_id), F.lit(" "), span(start, end)), "ZH", en, zh, 220)
    return F.when(cue_id.isNull(), F.lit(f"- {label}: <none>")).otherwise(line)


def block(lines: Column) -> Column:
    """Lines of an array, or a mark that there is none."""
    return F.when(F.coalesce(F.size(lines), F.lit(0)) > 0, F.array_join(lines, "\n")).otherwise(F.lit(NONE))


def cue_prompt(cue_id: Column, start: Column, end: Column, source: Column, current: Column, context: Column, frames: Column) -> Column:
    """For one cue by itself. ``frames``: none, mid or three."""
    seen = F.when(frames == "none", "No frame comes with this cue.").when(frames == "mid", "One frame (mid) comes with this cue.").otherwise("Three frames (start, mid, end) come with this cue.")
    return F.concat_ws("\n", F.lit("Revise the Chinese subtitle of one cue; times stay as they are."), seen, F.concat(F.lit("cue_id: "), _id(cue_id)), F.concat(F.lit("time: "), ms_to_ts(start), F.lit(" --> "), ms_to_ts(end)), F.concat(F.lit("source: "), F.coalesce(source, F.lit(""))), F.concat(F.lit("current: "), F.coalesce(current, F.lit(""))), F.lit("context:"), context, F.lit("Keep names in English. Answer with one JSON object of the given schema."))


def window_prompt(history: Column, window: Column, lookahead: Column, images: Column, ids: Column) -> Column:
    """For a window of cues; all but ``ids`` are arrays of lines."""
    return F.concat_ws("\n", F.lit("Translate the cues of this window together."), F.lit("history:"), block(history), F.lit("window:"), block(window), F.lit("next, not to be answered:"), block(lookahead), F.lit("images, in this order:"), block(images), F.concat(F.lit("Answer with one JSON item for each of: ["), F.array_join(F.transform(ids, lambda x: x.cast("string")), ", "), F.lit("]")))


def refine_prompt(cue_id: Column, prev: Column, current: Column, nxt: Column) -> Column:
    return F.concat_ws("\n", F.concat(F.lit("Refine the flow between cues; the focus is cue "), _id(cue_id), F.lit(".")), prev, current, nxt, F.lit("The next cue must not change. Answer with one JSON object of the given schema."))
