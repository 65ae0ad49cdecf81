"""Runs with backends that fail, rewrite and ask to be joined; counters; options; files."""

import itertools
import json
import sys
import zlib

import pytest
from pyspark import cloudpickle

from cuelake import options
from cuelake.functions import lexical
from cuelake.operators import results, run, segment, track
from cuelake.operators.run import Answer, Cue, MockBackend, Serial
from cuelake.plans import registry
from cuelake.sources import files
from cuelake.streaming import sessions

D = "/root/testdata/sf0.001"
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests


def _cues(n):
    return [Cue(i, 1000 * i, 1000 * i + 900, f"text {i}") for i in range(1, n + 1)]


class Recorder(MockBackend):
    raw = False

    def __init__(self, fails=(), drops=()):
        self.fails, self.drops, self.asked = fails, drops, []

    def window(self, history, window, lookahead):
        self.asked.append(([c.cue_id for c, _ in history], [c.cue_id for c, _ in window], [c.cue_id for c in lookahead]))
        if window[0][0].cue_id in self.fails:
            raise TimeoutError
        return [Answer(c.cue_id, f"new{len(self.asked)} {c.cue_id}.") for c, _ in window if c.cue_id not in self.drops]


def test_serial_windows_and_history():
    b = Recorder()
    got = run.serial_track(_cues(5), b, Serial(size=3, overlap=1, history=2))
    assert b.asked == [([], [1, 2, 3], [4, 5]), ([1, 2], [3, 4, 5], []), ([3, 4], [5], [])]
    assert got[3].text == "new2 3" and got[5].text == "new3 5" and got[1].confidence == 0.5


def test_serial_statuses():
    b = Recorder(fails={3}, drops={4})
    got = run.serial_track(_cues(4), b, Serial(size=3, overlap=1))
    assert {k: d.status for k, d in got.items()} == {1: "ok", 2: "ok", 3: "ok", 4: "fail"}  # an ok is not taken back
    done = [c._replace(existing="x") for c in _cues(3)] + _cues(5)[3:]
    got = run.serial_track(done, Recorder(), Serial(size=3, overlap=1))
    assert {k: d.status for k, d in got.items()} == {1: "skipped", 2: "skipped", 3: "ok", 4: "ok", 5: "ok"}
    assert not run.serial_track([], Recorder(), Serial())


class Editor(MockBackend):
    def refine(self, prev, current, following, sources):
        if current.cue_id == 3:
            return Answer(99, "other")
        if current.cue_id == 4:
            raise TimeoutError
        return Answer(current.cue_id, f"{current.text}!", prev=f"{prev.text}?" if prev and current.cue_id == 2 else None)


def test_refine_counts_and_checkpoints():
    saved = []
    out, n = run.refine_track(_cues(5), [""] * 5, Editor(), start_id=1, end_id=4, checkpoint=lambda cues, k: saved.append(k), every=2)
    assert [c.text for c in out] == ["text 1!?", "text 2!", "text 3", "text 4", "text 5"]
    assert n == run.Refined(4, 2, 1, 2, 1) and saved == [2, 4, 4]
    assert run.refine_track(_cues(5), [""] * 5, Editor(), limit=1)[1].processed == 1


def test_runs_on_tables(spark):
    cues = spark.createDataFrame([(1, i, *c[:4]) for i, c in enumerate(_cues(7))], "track_id long, pos long, cue_id long, start_ms long, end_ms long, text string")
    got = {r.cue_id: r for r in run.serial_run(cues, backend=Recorder(drops={7})).collect()}
    assert len(got) == 7 and got[7].status == "fail" and got[7].revised_zh is None
    assert {r.text for r in run.refine(cues, cues, Editor()).collect()} >= {"text 1!?", "text 7!"}
    assert run.serial_run(cues.where("false")).count() == run.cue_run(cues.where("false")).count() == 0


def test_merge_counts(spark):
    cues = spark.createDataFrame([(1, i, i + 1, 1000 * i, 1000 * i + 950, "s") for i in range(6)], "track_id long, pos long, cue_id long, start_ms long, end_ms long, text string")
    rows = [(1, 1, "一", 0.9, False, True), (1, 2, "二", 0.1, True, True), (1, 3, "，三", 0.9, True, True), (1, 4, "x", 0.9, False, False), (1, 5, "", 0.9, False, True)]
    found = spark.createDataFrame([(*r[:5], False, None, None, r[5]) for r in rows], "track_id long, cue_id long, revised_zh string, confidence double, join_with_prev boolean, has_anchor boolean, anchor_start_ratio double, anchor_end_ratio double, valid boolean")
    got = results.merge_counts(cues, found, results.Joins.checked(min_confidence=0.5, chars=1)).first()
    assert (got.revised, got.low_confidence, got.joined, got.blocked, got.missing, got.invalid, got.total, got.output) == (3, 1, 1, 1, 1, 1, 6, 5)
    assert results.Joins.checked(chars=1, chain=0, least_ms=1) == results.Joins(chars=8, chain=1, least_ms=80)


def test_segments_are_optimal_and_finished():
    """The path against all partitions, and the limits after repair."""
    runs = [segment.Segment(i, j, float(i), j + 0.9, 1.0, (7 * i + 3 * j * j) % 11 - 4.0, "t", 1.0) for i in range(8) for j in range(i, 8) if (i + j) % 5 != 4]
    by = {(r.i, r.j): r.cost for r in runs}
    best = min(sum(by[p] for p in parts) for k in range(8) for cuts in itertools.combinations(range(1, 8), k) for parts in [list(zip((0, *cuts), (c - 1 for c in (*cuts, 8))))] if all(p in by for p in parts))
    assert sum(s.cost for s in segment.cheapest(8, runs)) == best
    assert segment.cheapest(2, runs[:1]) is None and segment.cheapest(0, []) == []
    lim, tokens = segment.Limits(), ["a", "bb", "ccc", "dddd"]
    short = [segment.Segment(0, 0, 1.0, 1.2, 0.5, 0.0, "a", 1.0), segment.Segment(1, 2, 1.3, 1.5, 0.5, 0.0, "bb ccc", 1.0), segment.Segment(3, 3, 9.0, 9.1, 0.5, 0.0, "dddd", 1.0)]
    grown = segment.padded(short, lim)
    assert all(a.end <= b.start + 1e-9 for a, b in zip(grown, grown[1:])) and grown[2].end - grown[2].start == pytest.approx(5 / 6)
    fused = segment.merged(short, tokens, lim)
    assert [(s.i, s.j) for s in fused] == [(0, 2), (3, 3)] and fused[0].text == "a bb ccc"


def test_clean_text():
    for raw, want in ((" a  ( b ) , c – d", "a (b), c - d"), ("it 's", "it's"), ("", "")):
        assert lexical.clean_py(raw) == want


def test_targets_of_cues_that_do_not_last(spark):
    cues = spark.createDataFrame([(1, 1, 1000, 400), (1, 2, 500, 500)], "track_id long, cue_id long, start_ms long, end_ms long")
    assert {(r.cue_id, r.t_ms) for r in track.frame_targets(cues).collect()} == {(1, 1000.0), (2, 500.0)}


def test_options():
    assert options.options("run")["start_id"] is None and options.options("run", {"serial-overlap": "2"}, serial_overlap=3)["serial_overlap"] == 3
    with pytest.raises(KeyError):
        options.options("merge", {"nothing": 1})
    with pytest.raises(ValueError):
        options.options("prepare", frame_mode="four")


def test_option_file(tmp_path):
    (tmp_path / "o.yaml").write_text("# x\nserial-overlap: 2 # two\nmock: true\ntranslator: 'mock'\n")
    assert options.options("run", options.load(str(tmp_path / "o.yaml")))["mock"] is True


def test_files(spark, tmp_path):
    cues = registry.queries()["cues_from_words"](spark, D)
    files.write_srt(cues, f"{tmp_path}/srt")
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "7.srt").write_text("﻿1\r\n00:00:01,000 --> 00:00:02,500\r\nhello\r\nthere\r\n")
    got = files.read_srt(spark, f"{tmp_path}/more").first()
    assert (got.track_id, got.cue_id, got.start_ms, got.end_ms, got.text) == (7, 1, 1000, 2500, "hello\nthere")
    image = files.png(2, 1, bytes(range(6)))
    assert image[:8] == b"\x89PNG\r\n\x1a\n" and zlib.decompress(image[41 : 41 + int.from_bytes(image[33:37], "big")]) == b"\0" + bytes(range(6))
    (tmp_path / "frames" / "discarded_preview").mkdir(parents=True)
    (tmp_path / "frames" / "a.png").write_bytes(image)
    (tmp_path / "frames" / "discarded_preview" / "b.png").write_bytes(image)
    assert [r.bytes for r in files.list_frames(spark, f"{tmp_path}/frames", "png").collect()] == [len(image)]
    with pytest.raises(ValueError):
        files.png(2, 2, b"")
    tasks = files.list_tasks(spark.createDataFrame([("/x/000010",), ("/x/000002/",), ("/x/readme",)], "path string"))
    assert [r.cue_id for r in tasks.collect()] == [2, 10]


def test_segment_reports(spark):
    rows = registry.queries()["segment_report"](spark, D).collect()
    for r in rows:
        doc = json.loads(r.report)
        assert doc["stats"]["segment_count"] == len(doc["segments"]) and doc["validation"]["passed"] == (not doc["validation"]["issues"])


def test_streaming(spark, tmp_path):
    spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:20"), (1, "2024-01-01 00:02:00"), (2, "2024-01-01 01:00:00")], "k long, t string").selectExpr("k", "cast(t as timestamp) as t").coalesce(1).write.parquet(f"{tmp_path}/in")
    points = spark.readStream.schema("k long, t timestamp").parquet(f"{tmp_path}/in")
    q = sessions.start(sessions.session_windows(points, "k", "t", "30 seconds", "1 minute"), f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(60)
    assert sorted((r.k, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, 1), (1, 2)]  # the newest is still open
    assert sessions.running_counts(spark.createDataFrame([(1, 5), (1, 9)], "track_id long, end_ms long")).first()[1:] == (2, 9)
