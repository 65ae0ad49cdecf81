"""Row functions on literals, against plain Python where SQL cannot express them."""

import math
import re

import pytest
from pyspark.sql import functions as F

from cuelake.functions import text as tx
from cuelake.operators import timing


def test_collapse_repeats(spark):
    word = "\u4e00-\u9fffA-Za-z0-9"
    pattern = re.compile(f"(?<![{word}])([{word}]{{2,20}})[，,、\\s]+\\1([！？!?]?)(?=$|[，,。！？!?；;])")

    def plain(t):
        now, was = " ".join((t or "").split()), None
        while now != was:
            now, was = pattern.sub(r"\1\2", now), now
        return now

    rows = ["小麻烦，小麻烦", "小麻烦，小麻烦。", "go go, go go!", "ab ab ab ab ab ab ab", ",".join(["xyz"] * 40), "好，好", "a\u3000b  c", None, "", "no repeats here", "很好, 很好！，真的 真的?"]
    got = spark.createDataFrame([(t,) for t in rows], "t string").select(tx.collapse_repeats(F.col("t"))).collect()
    assert [r[0] for r in got] == [plain(t) for t in rows]
    assert plain(rows[0]) == "小麻烦" and plain(rows[4]) == "xyz"


@pytest.mark.parametrize("value, want", [("0.25", 0.25), ("x", 0.5), (None, 0.5), ("NaN", 0.5), ("1e400", 0.5), ("-3", 0.0), ("7", 1.0)])
def test_ratio(spark, value, want):
    got = spark.createDataFrame([(value,)], "v string").select(timing.ratio(F.col("v"), 0.5)).first()[0]
    assert math.isclose(got, want)


def test_anchor_edges(spark):
    rows = [(1, 1, 0, 1000, True, 0.9, 0.1), (1, 2, 0, 1, True, 0.2, 0.8), (1, 3, 0, 1000, None, 0.2, 0.8), (1, 4, 0, 1000, True, None, None), (1, 5, 0, 1000, True, 1.0, 1.0), (1, 6, 0, 100, True, 0.5, 0.5)]
    df = spark.createDataFrame(rows, "track_id long, cue_id long, start_ms long, end_ms long, has_anchor boolean, anchor_start_ratio double, anchor_end_ratio double")
    got = {r.cue_id: (r.start_ms, r.end_ms, r.anchored) for r in timing.anchor_spans(df, 200).collect()}
    assert got == {1: (100, 900, True), 2: (0, 1, False), 3: (0, 1000, False), 4: (0, 1000, True), 5: (800, 1000, True), 6: (0, 100, True)}


def test_image_policy_rand1(spark):
    cues = spark.createDataFrame([(1, 1), (1, 2)], "track_id long, cue_id long")
    frames = spark.createDataFrame([(1, 1, "end"), (1, 1, "start")], "track_id long, cue_id long, slot string")
    got = {r.cue_id: (r.images, r.reason) for r in timing.image_policy(cues, frames, "rand1").collect()}
    assert got[1][0] in ("start", "end") and got[2] == ("", None)


def test_validation_report(spark):
    rows = [(1, 0, 0, 1000, "fine"), (1, 1, 900, 900, "a\n b  c – d"), (1, 2, 900, 9000, "x" * 43), (2, 0, 0, 1000, None), (2, 1, 1000, 2000, "y" * 21)]
    df = spark.createDataFrame(rows, "track_id long, pos long, start_ms long, end_ms long, text string")
    got = [tuple(r) for r in timing.validation_report(df).orderBy("track_id", "pos", "rule").collect()]
    assert [g[:3] for g in got] == [(1, 1, 1), (1, 1, 2), (1, 1, 4), (1, 1, 5), (1, 1, 6), (1, 1, 7), (1, 2, 1), (1, 2, 3), (2, 1, 4)]
    assert got[0][3] == "duration 0.000s out of [0.833, 7.000]" and got[-1][3] == "cps 21.00 > 20.00" and got[2][3] == "cps inf > 20.00"


def test_two_places(spark):
    values = [0.125, 0.375, 14.305, 14.315, 2.675, 1.005, 20.0, 0.0, 14.625, *(n / d for n in range(1, 60) for d in (0.8, 1.6, 2.4, 3.2, 1.12, 2.001))]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(tx.two_places(F.col("v"))).collect()
    assert [r[0] for r in got] == [f"{v:.2f}" for v in values]
