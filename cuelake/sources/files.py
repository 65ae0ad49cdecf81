"""Files in and out: subtitles, aligned words, frames and results, as tables keyed by track."""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions.text import ms_to_ts, seconds_to_ts, strip
from .tables import parse_srt, render_srt

ALIGNED = "language string, segments array<struct<words:array<struct<word:string,start:double,end:double>>>>"


def _track(path: str = "_metadata.file_path") -> Column:
    return F.regexp_extract(path, "([0-9]+)[^/]*$", 1).cast("long")


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    """Cues of subtitle files; a file's track is the first number of its name."""
    return parse_srt(spark.read.text(path, wholetext=True).select(_track().alias("track_id"), F.col("value").alias("content")))


def write_srt(cues: DataFrame, path: str) -> None:
    """One folder ``track_id=N`` with one file for each track."""
    render_srt(cues).select("track_id", F.col("content").alias("value")).write.partitionBy("track_id").text(path)


def render_seconds(segments: DataFrame) -> DataFrame:
    """Subtitle and plain text of segments in seconds, numbered in order: track_id, srt, txt."""
    n = F.row_number().over(W.partitionBy("track_id").orderBy("start", "idx"))
    b = F.concat(n.cast("string"), F.lit("\n"), seconds_to_ts(F.col("start")), F.lit(" --> "), seconds_to_ts(F.col("end")), F.lit("\n"), F.col("text"), F.lit("\n\n"))
    rows = segments.select("track_id", n.alias("n"), b.alias("b"), "text")
    all_ = F.sort_array(F.collect_list(F.struct("n", "b", "text")))
    return rows.groupBy("track_id").agg(all_.alias("x")).select("track_id", F.array_join(F.transform("x", lambda e: e["b"]), "").alias("srt"), F.concat(F.array_join(F.transform("x", lambda e: e["text"]), "\n"), F.lit("\n")).alias("txt"))


def aligned_words(documents: DataFrame) -> DataFrame:
    """(track_id, pos, word, start, end) of (track_id, doc) JSON documents, in time order; words without times or text go."""
    d = documents.select("track_id", F.from_json("doc", ALIGNED).alias("d"))
    w = d.select("track_id", F.posexplode("d.segments").alias("seg", "s")).select("track_id", "seg", F.posexplode("s.words").alias("idx", "w"))
    w = w.select("track_id", "seg", "idx", strip(F.col("w.word")).alias("word"), F.col("w.start").alias("start"), F.col("w.end").alias("end")).where("start is not null and end is not null and word != ''")
    pos = F.row_number().over(W.partitionBy("track_id").orderBy("start", "end", "seg", "idx")) - 1
    return w.select("track_id", pos.cast("long").alias("pos"), "word", "start", "end")


def list_frames(spark: SparkSession, folder: str, ext: str = "jpg") -> DataFrame:
    """(path, bytes, b64) of image files below a folder, those in ``discarded_preview`` left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{ext}").load(folder)
    return found.where(~F.col("path").contains("discarded_preview")).select("path", F.col("length").alias("bytes"), F.base64("content").alias("b64"))


def list_tasks(paths: DataFrame) -> DataFrame:
    """(cue_id, path) of folders named by a number, in its order. paths: (path)."""
    name = F.regexp_extract("path", "([^/]+)/?$", 1)
    return paths.where(name.rlike("^[0-9]+$")).select(name.cast("long").alias("cue_id"), "path").orderBy("cue_id")


def png(width: int, height: int, rgb: bytes) -> bytes:
    """An RGB image of 8 bits; the bytes must fill it exactly."""
    if len(rgb) != width * height * 3:
        raise ValueError("size of the image and its bytes differ")
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + rgb[k : k + width * 3] for k in range(0, len(rgb), width * 3))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows, 6)) + part(b"IEND", b"")


def task_metas(cues: DataFrame) -> DataFrame:
    """(track_id, cue_id, meta): the JSON document of each cue with its times as text."""
    doc = F.struct("cue_id", ms_to_ts(F.col("start_ms")).alias("start"), ms_to_ts(F.col("end_ms")).alias("end"), "start_ms", "end_ms", F.col("text").alias("src_text"))
    return cues.select("track_id", "cue_id", F.to_json(doc).alias("meta"))
