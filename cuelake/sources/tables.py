"""Caption tables derived from the driver's tables, and subtitle text parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

TIME_LINE = "^\\s*(\\d{2}):(\\d{2}):(\\d{2})[,.](\\d{3})\\s*-->\\s*(\\d{2}):(\\d{2}):(\\d{2})[,.](\\d{3})\\s*$"


def words(spark: SparkSession, d: str) -> DataFrame:
    """track_id, pos, word, start_ms, end_ms, one row per token of a conversation."""
    # Dealt by track as texts, before they are cut: far fewer bytes move, and the cutting is spread however few files there are.
    rows = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "text").repartition("conv_id").select("conv_id", "turn", F.posexplode(F.split("text", "\\s+")).alias("i", "word")).where("word != ''")
    w = W.partitionBy("conv_id").orderBy("turn", "i")
    rows = rows.select(F.col("conv_id").alias("track_id"), (F.row_number().over(w) - 1).cast("long").alias("pos"), "word")
    gap = F.pmod(F.col("pos") * 37 + F.col("track_id") * 11, F.lit(400)) + F.when(F.col("pos") % 17 == 16, 900).otherwise(0)
    rows = rows.withColumn("dur", F.length("word").cast("long") * 60).withColumn("gap", gap.cast("long"))
    before = F.coalesce(F.sum(F.col("dur") + F.col("gap")).over(W.partitionBy("track_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    return rows.select("track_id", "pos", "word", before.alias("start_ms"), (before + F.col("dur")).alias("end_ms"))


def cues(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d).withColumn("cpos", F.floor(F.col("pos") / 4))
    g = w.groupBy("track_id", F.col("cpos").alias("pos")).agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("text")
    )
    return g.select("track_id", "pos", (F.col("pos") + 1).alias("cue_id"), "start_ms", "end_ms", "text")


def parse_srt(raw: DataFrame) -> DataFrame:
    """(track_id, content) to cues in file order; a bad time line fails the job, an empty file gives none."""
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("content", "^﻿", ""), "\r\n?", "\n"), "(?U)^\\s+|\\s+$", "")
    b = raw.select("track_id", F.posexplode(F.split(body, "\\n\\s*\\n")).alias("pos", "block")).where("block != ''")
    lines = F.split("block", "\n")
    has_id = F.trim(F.get(lines, F.lit(0))).rlike("^[0-9]+$")
    line = F.when(has_id, F.get(lines, F.lit(1))).otherwise(F.get(lines, F.lit(0)))
    part = lambda i: F.regexp_extract(line, TIME_LINE, i).cast("long")
    ms = lambda i: ((part(i) * 60 + part(i + 1)) * 60 + part(i + 2)) * 1000 + part(i + 3)
    ok = F.when(F.coalesce(line, F.lit("")).rlike(TIME_LINE), line).otherwise(F.raise_error(F.concat(F.lit("bad time line: "), F.coalesce(line, F.lit("")))))
    text = F.array_join(F.transform(F.slice(lines, F.when(has_id, 3).otherwise(2), F.greatest(F.size(lines), F.lit(1))), lambda x: F.rtrim(x)), "\n")
    rows = b.where(ok.isNotNull()).select("track_id", F.col("pos").cast("long").alias("pos"), F.when(has_id, F.trim(F.get(lines, F.lit(0))).cast("long")).alias("id"), ms(1).alias("start_ms"), ms(5).alias("end_ms"), F.trim(text).alias("text"))
    w = W.partitionBy("track_id").orderBy("pos")
    grp = F.count("id").over(w)
    rows = rows.withColumn("g", grp)
    run = F.row_number().over(W.partitionBy("track_id", "g").orderBy("pos"))
    auto = F.coalesce(F.first("id").over(W.partitionBy("track_id", "g").orderBy("pos")), F.lit(0)) + run - F.when(F.col("g") > 0, 1).otherwise(0)
    return rows.select("track_id", "pos", auto.alias("cue_id"), "start_ms", "end_ms", "text")


def render_srt(cues: DataFrame) -> DataFrame:
    """One subtitle file's content per track, renumbered from 1."""
    from ..functions.text import ms_to_ts

    n = F.row_number().over(W.partitionBy("track_id").orderBy("pos"))
    block = F.concat(n.cast("string"), F.lit("\n"), ms_to_ts(F.col("start_ms")), F.lit(" --> "), ms_to_ts(F.col("end_ms")), F.lit("\n"), F.col("text"), F.lit("\n"))
    rows = cues.select("track_id", n.alias("n"), block.alias("block"))
    return rows.groupBy("track_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "block"))), lambda x: x["block"]), "\n").alias("content"))
