"""Model replies as rows: lenient JSON and the shapes that translated items come in.

A single object is found with native expressions. Items of free shape need a parser and go through one Arrow-batched
function; a reply that gives none has null items, never an error, so that one bad reply does not fail a job.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..shipping import ship_package
from .text import strip

ITEM = "struct<cue_id:string,revised_zh:string,confidence:double,join_with_prev:boolean>"
SCHEMA = f"id long, items array<{ITEM}>"
# Names under which a text, or the list of items, may come.
ALIASES = ("translation", "current_zh", "zh", "ZH")
LISTS = ("items", "translations", "results", "cues")
#: Fixed value: a list item that names a cue.
_BULLET = re.compile(r"[-*]\s*(?:[`*]*(?:cue\s*)?)?(\d+)[`*]*\s*[:：]\s*(.+)", re.IGNORECASE)


def object_text(c: Column) -> Column:
    """The JSON object that a text is or, if it is no JSON, holds from its first to its last brace; null if there is none."""
    whole = strip(c)
    part = F.regexp_extract(whole, "(?s)\\{.*\\}", 0)
    parsed, inner = F.try_parse_json(whole), F.try_parse_json(part)
    return F.when(parsed.isNotNull(), F.when(F.schema_of_variant(parsed).startswith("OBJECT"), whole)).when(inner.isNotNull(), part)


def unfenced(text: str) -> str:
    """Text without the marks of a code block around it."""
    text = re.sub(r"\A```(?:json)?", "", text.strip())
    return re.sub(r"```\s*\Z", "", text).strip()


def readings(text: str, brackets: tuple[str, ...] = ("{}", "[]")) -> Iterator[object]:
    """What the text parses to: as it is, then from first to last bracket of each kind."""
    spans = [text] + [m.group() for a, b in brackets if (m := re.search(rf"(?s)\{a}.*\{b}", text))]
    for s in spans:
        try:
            yield json.loads(s)
        except ValueError:
            continue


def any_json(text: str) -> object:
    """The first reading of a text; ``ValueError`` if it has none."""
    for value in readings(unfenced(text)):
        return value
    raise ValueError("no JSON in the text")


def _first(d: dict, names) -> object:
    return next((d[n] for n in names if n in d), None)


def items_of(value: object) -> list[dict]:
    """Items out of a list, an object with a list, a single item, or an object keyed by id."""
    if isinstance(value, list):
        rows = [dict(x) for x in value if isinstance(x, dict)]
        for x in rows:
            names = ALIASES if x.get("cue_id") is None else (*ALIASES, "text")
            x.setdefault("revised_zh", _first(x, names))
        return rows
    if not isinstance(value, dict):
        return []
    inner = next((value[k] for k in LISTS if isinstance(value.get(k), list)), None)
    if inner is not None:
        return items_of(inner)
    text = value.get("revised_zh") if "revised_zh" in value else _first(value, (*ALIASES, "text"))
    if isinstance(text, str):
        return [{**value, "revised_zh": text}]
    keyed = []
    for k, v in value.items():
        number = re.search(r"-?\d+" if re.fullmatch(r"\s*[+-]?\d+\s*", k) else r"\d+", k)
        own = v if isinstance(v, dict) else {}
        said = v if isinstance(v, str) else next((own[n] for n in ("revised_zh", "translation", "zh", "text") if own.get(n)), None)
        if number and isinstance(said, str) and (isinstance(v, str) or said.strip()):
            keyed.append({"cue_id": int(number.group()), "revised_zh": said, "confidence": own.get("confidence") or 0.5})
    return keyed


def event_items(text: str) -> list[dict]:
    """Items of a reply in lines of events: the joined text parts as JSON, else as a list of ``- id: text`` lines."""
    parts = []
    for line in text.strip().split("\n"):
        e = next(readings(line, ()), None)
        if isinstance(e, dict) and e.get("type") == "text" and isinstance(p := e.get("part"), dict) and p.get("type") == "text":
            parts.append(str(p.get("text", "")))
    body = unfenced("\n".join(parts))
    found = next((x for v in readings(body, ("[]", "{}")) if (x := items_of(v))), None)
    if found is not None:
        return found
    bullets = [m for line in body.split("\n") if (m := _BULLET.search(line.strip()))]
    return [{"cue_id": int(m[1]), "revised_zh": m[2].strip(), "confidence": 0.5} for m in bullets]


def _row(x: dict) -> dict:
    cue, text, sure, join = (x.get(k) for k in ("cue_id", "revised_zh", "confidence", "join_with_prev"))
    return {
        "cue_id": None if cue is None else str(cue),
        "revised_zh": text if isinstance(text, str) else None,
        "confidence": float(sure) if isinstance(sure, (int, float)) else None,
        "join_with_prev": join if isinstance(join, bool) else None,
    }


def reply_items(replies: DataFrame, events: bool = False) -> DataFrame:
    """(id, items) of (id, payload); ``events`` for replies in lines of events. Null where a reply has no items."""
    ship_package(replies.sparkSession)

    def read(payload):
        try:
            found = event_items(payload or "") if events else items_of(any_json(payload or ""))
        except ValueError:
            found = []
        return [_row(x) for x in found] or None

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "items": b["payload"].map(read)})

    return replies.select(F.col("id").cast("long").alias("id"), F.col("payload").cast("string").alias("payload")).mapInPandas(run, SCHEMA)
