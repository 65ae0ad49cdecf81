"""The result fold on rows worked out by hand, and what must hold on the tables."""

import pytest

from cuelake.operators.results import Caption, Joins, Row, fold, merge_results
from cuelake.plans import registry

LIM = Joins()


def row(i, start, end, text, join=False, cue_end=None):
    return Row(i, start, end, end if cue_end is None else cue_end, text, f"s{i}", join)


@pytest.mark.parametrize(
    "start, text, want",
    [
        (1800, "乙", [Caption(1, 0, 2500, "甲乙*", "s1 s2", 2)]),
        (1801, "，乙", [Caption(1, 0, 1000, "甲*", "s1", 1), Caption(2, 1801, 2500, "，乙", "s2", 1)]),
        (940, "乙", [Caption(1, 0, 2500, "甲乙*", "s1 s2", 2)]),
        (939, "，乙", [Caption(1, 0, 1000, "甲*", "s1", 1), Caption(2, 1000, 2500, "，乙", "s2", 1)]),
        (1100, "， " + "乙" * 28, [Caption(1, 0, 1000, "甲*", "s1", 1), Caption(2, 1100, 2500, "乙" * 28, "s2", 1)]),
    ],
)
def test_join(start, text, want):
    assert fold([row(1, 0, 1000, "甲*"), row(2, start, 2500, text, True)], LIM) == want


def test_chain_and_overlap():
    got = fold([row(1, 0, 500, "a"), row(2, 500, 900, "b", True), row(3, 900, 1200, ",c", True)], LIM)
    assert [(c.text, c.start, c.end) for c in got] == [("a b", 0, 900), ("c", 900, 1200)]
    got = fold([row(1, 0, 1000, "a"), row(2, 200, 700, "b"), row(3, 300, 400, "c", cue_end=5000)], LIM)
    assert [(c.start, c.end) for c in got] == [(0, 1000), (1000, 1001), (1001, 1221)]
    assert fold([row(1, 5, 9, "x", True)], LIM) == [Caption(1, 5, 9, "x", "s1", 1)]


def test_frames(spark):
    cues = spark.createDataFrame([(1, 0, 1, 0, 1000, "a"), (1, 1, 2, 1000, 2000, "b"), (1, 2, 3, 5000, 6000, None)], "track_id long, pos long, cue_id long, start_ms long, end_ms long, text string")
    found = spark.createDataFrame([(1, 1, "甲。", 0.2, None, None, None, None), (1, 2, " ", 0.2, None, True, 0.5, None)], "track_id long, cue_id long, revised_zh string, confidence double, join_with_prev boolean, has_anchor boolean, anchor_start_ratio double, anchor_end_ratio double")
    got = [tuple(r)[2:] for r in merge_results(cues, found, Joins(min_confidence=0.5)).orderBy("pos").collect()]
    assert got == [(1, 0, 1000, "甲*", "a"), (2, 1500, 2000, "b", "b"), (3, 5000, 6000, "", "")]


def test_tables(spark):
    got = registry.queries()["merge_results"](spark, "/root/testdata/sf0.001").toPandas().sort_values(["track_id", "pos"])
    assert len(got)
    for _, g in got.groupby("track_id"):
        assert (g.end_ms > g.start_ms).all() and (g.start_ms.to_numpy()[1:] >= g.end_ms.to_numpy()[:-1]).all()
