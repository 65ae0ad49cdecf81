"""Tracks as runs of rows, runs of words against brute force, and what the plans of folds are made of."""

import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cuelake.functions import lexical
from cuelake.operators import folding, segment
from cuelake.plans import registry

D = "/root/testdata/sf0.001"
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, tracks):
    """Words of (text, start_ms, end_ms) by track."""
    return spark.createDataFrame([(t, p, *w) for t, ws in tracks.items() for p, w in enumerate(ws)], "track_id long, pos long, word string, start_ms long, end_ms long")


def test_tracks_over_batches(spark):
    """Tracks that span batches and tracks within one, each whole and in order, the null track too."""
    rows = spark.range(0, 4000, 1, 5).select(F.when(F.col("id") < 2500, 1).when(F.col("id") < 3000, None).otherwise(F.col("id") % 300).alias("track_id"), (-F.col("id")).alias("pos"), F.col("id").cast("string").alias("x"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got = folding.by_tracks(rows, folding.in_rows(lambda t: [(len(t["x"]), bool((t["pos"][1:] > t["pos"][:-1]).all()), t["x"][0], t["x"][-1])]), "track_id long, n int, ordered boolean, first string, last string", ("pos",)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 302 - 1 + (1 not in {k % 300 for k in range(3000, 4000)}) and all(r.ordered for r in got)
    by = {r.track_id: r for r in got}
    assert (by[None].n, by[None].first, by[None].last) == (500, "2999", "2500") and by[1].n == 2500 + len([k for k in range(3000, 4000) if k % 300 == 1])


def test_candidates_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words, at = [], 0
    for _ in range(120):
        long = rng.choice([200, 400, 700]) if rng.random() > 0.05 else 6000  # ends may lie behind those of later words
        words.append((rng.choice(["a", "the", "Captions", ",", "(", ")", "'s", "it –", "so.", " x ", "b ", "!", "", "　", "c\x1cd"]), at, at + long))
        at += rng.choice([150, 300, 900])
    got = {(r.i, r.j): (r.text, r.chars) for r in segment.candidates(table(spark, {1: words, 2: words[:1]})).where("track_id = 1").collect()}
    lim, want = segment.Limits(), {}
    tidied = spark.createDataFrame([(i, j, " ".join(w[0].strip(" ") for w in words[i : j + 1])) for i in range(120) for j in range(i, min(120, i + 42))], "i int, j int, t string").select("i", "j", lexical.clean(F.col("t")).alias("t")).collect()
    for i, j, text in tidied:
        raw, least = words[j][2] / 1000 - words[i][1] / 1000, sum(len(w[0]) for w in words[i : j + 1])
        before, behind = (words[i - 1][2] / 1000 if i else 0.0), (words[j + 1][1] / 1000 if j < 119 else words[j][2] / 1000 + lim.min_dur)
        shown = min(7.0, raw + max(0.0, words[i][1] / 1000 - before) + max(0.0, behind - words[j][2] / 1000) + 0.18)
        if 0 < raw <= 7 and least <= 42 and len(text) <= 42 and len(text) / 20 <= shown + 1e-6:
            want[i, j] = text, len(text)
    assert got == want
    # In blocks as whole.
    one = lambda: sorted(map(tuple, segment.candidates(table(spark, {1: words})).collect()))
    whole = one()
    monkeypatch.setattr(segment, "BLOCK", 7)
    assert one() == whole


@pytest.mark.parametrize("name", ["dp_candidates", "dp_segments"])
def test_words_are_not_dealt_again(spark, name):
    """Texts are dealt once, as whole texts, and no table of runs is made."""
    p = plan(registry.queries()[name](spark, D))
    assert p.count("Exchange") == 1 and "MapInArrow" in p and "FlatMap" not in p


def test_report_finds_segments_once(spark):
    assert plan(registry.queries()["segment_report"](spark, D)).count("MapInArrow") == 1


@pytest.mark.parametrize("name", ["resegment", "resegment_counts", "merge_results", "merge_counts", "serial_run", "status_counts", "refine_run", "refine_counts"])
def test_small_tracks_cost_no_group(spark, name):
    p = plan(registry.queries()[name](spark, D))
    assert "MapInArrow" in p and "FlatMapGroups" not in p


def test_border_flags_are_made_once(spark):
    """The bare word is made once for a word, not for each flag that asks for it."""
    assert plan(registry.queries()["boundary_cost"](spark, D)).count("regexp_replace") <= 6
