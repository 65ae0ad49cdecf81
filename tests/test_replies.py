"""Replies in every shape, against results worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from cuelake.functions import replies as r


def pairs(items):
    return [(str(x.get("cue_id")), x.get("revised_zh")) for x in items]


@pytest.mark.parametrize(
    "text, want",
    [
        ('[{"cue_id": 1, "zh": "a"}, 5, {"cue_id": "2", "text": "b"}, {"text": "c"}]', [("1", "a"), ("2", "b"), ("None", None)]),
        ('```json\n{"translations": [{"cue_id": 7.0, "revised_zh": "x"}]}\n```', [("7.0", "x")]),
        ('Sure! {"text": "only"} bye', [("None", "only")]),
        ('{"3": "x", "cue_7": {"zh": "y"}, "k": "z", "-4": "m", "9": {"zh": " "}}', [("3", "x"), ("7", "y"), ("-4", "m")]),
        ('{"items": []}', []),
        ("5", []),
    ],
)
def test_items(text, want):
    assert pairs(r.items_of(r.any_json(text))) == want


def test_no_json():
    for t in ("", "plain", "{broken"):
        with pytest.raises(ValueError):
            r.any_json(t)


def event(text):
    return json.dumps({"type": "text", "part": {"type": "text", "text": text}})


@pytest.mark.parametrize(
    "text, want",
    [
        (event('[{"cue_id": 1, "revised_zh": "a"}]'), [("1", "a")]),
        ("5\nnot json\n" + event("so:") + "\n" + event('{"2": "b"}'), [("2", "b")]),
        (event("- `9`: first\n  - **cue 10**： second\nrest"), [("9", "first"), ("10", "second")]),
        ('{"type": "step"}', []),
        ("", []),
    ],
)
def test_events(text, want):
    assert pairs(r.event_items(text)) == want


def test_frames(spark):
    rows = [(1, '{"1": "x"}'), (2, None), (3, "no"), (None, '{"zh": "y", "confidence": "high", "join_with_prev": true}')]
    got = {x.id: x["items"] for x in r.reply_items(spark.createDataFrame(rows, "id long, payload string")).collect()}
    assert got[1][0].asDict() == {"cue_id": "1", "revised_zh": "x", "confidence": 0.5, "join_with_prev": None}
    assert got[2] is None and got[3] is None and got[None][0].join_with_prev and got[None][0].confidence is None
    objects = [' {"a": 1} ', "[1]", 'x {"a": 2} y', "", None, "{no}", '[{"a": 3}]']
    seen = spark.createDataFrame([(t,) for t in objects], "t string").select(r.object_text(F.col("t"))).collect()
    assert [x[0] for x in seen] == ['{"a": 1}', None, '{"a": 2}', None, None, None, None]
