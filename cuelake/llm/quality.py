"""Operator 5 [native]: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Only DataFrame expressions. Three kinds of n-gram are hashed: words, pairs of neighbouring words, and as a further feature pairs
of neighbouring shapes (words with runs of letters and digits folded, which leaves the punctuation). Counts over the whole
corpus and over the trusted rows make two smoothed multinomials of ``BUCKETS`` buckets for each kind, a fixed size. A
document's score is the mean of log p_target/p_raw over its words and word pairs plus the mean over its shapes; it is kept if
the score reaches ``THRESHOLD``. Null and empty texts have no words and fail the base rules; null ids are scored and never trusted;
repeated rows are scored alike; a score at the threshold is kept; very long texts are read whole; an empty table gives no row;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..shipping import materialize

BUCKETS = 1 << 14
THRESHOLD = -1.0
#: Trusted rows that the target multinomial is fitted on, those of smallest id hash; the raw one covers all rows.
TRUSTED_ROWS = 20_000
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")


def base_columns(rows: DataFrame) -> DataFrame:
    """``rows`` (row, doc_id, t) with the counted base rules of whole texts."""
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.select(
        "row",
        "doc_id",
        "t",
        words_of(F.col("t")).alias("w"),
        F.regexp_count("t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    rows = rows.select(
        "row",
        "doc_id",
        "t",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    # Hashes of 2, 4 and 8 words by doubling: each position joined with the one half a window on.
    for half in (1, 2, 4):
        rows = rows.withColumn("h", F.zip_with("h", F.slice("h", half + 1, F.greatest(F.size("h"), F.lit(1))), lambda x, y: F.xxhash64(x, y)))
    rows = rows.withColumn("h", F.slice("h", 1, F.greatest(F.size("h") - 7, F.lit(0))))
    # Windows in order of (hash, position); a window repeats if a neighbour in that order has its hash.
    s = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    rows = rows.withColumn("s", F.when(F.size("h") > F.size(F.array_distinct("h")), s)).drop("h")
    hits = F.flatten(F.filter(F.transform(F.zip_with("s", F.slice("s", 2, F.size("s")), lambda e, n: F.when(e["x"] == n["x"], F.array(e["i"], n["i"]))), lambda p: p), lambda p: p.isNotNull()))
    rows = rows.withColumn("at", F.sort_array(F.array_distinct(hits))).drop("s")
    covered = F.aggregate(
        "at",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-8).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(8), p - a["last"])).cast("long").alias("n"), p.alias("last")),
    )["n"]
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("at")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def score(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD, row: str | None = None) -> DataFrame:
    """Base columns plus ``llr`` and ``kept``, and the column ``row``, a unique number, where one is named.

    ``trusted_ids`` has the doc_id of trusted rows.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    rows = docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    rows = rows if row else materialize(rows, "rows")
    ids = trusted_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRUSTED_ROWS).withColumn("trusted", F.lit(1))
    marked = rows.join(F.broadcast(ids), "doc_id", "left")  # at most TRUSTED_ROWS ids
    counts = grams(marked, "trusted").groupBy("b").agg(F.count("*").alias("raw"), F.count("trusted").alias("good"))
    table = materialize(_weights(docs.sparkSession, materialize(counts, "counts")), "weights")
    weighed = grams(rows, "row").join(F.broadcast(table), "b")  # 3 BUCKETS rows
    shape, word = F.col("b") < BUCKETS, F.col("b") >= BUCKETS
    llr = weighed.groupBy("row").agg((F.sum(F.when(shape, F.col("x"))) / F.count_if(shape)).alias("shapes"), (F.sum(F.when(word, F.col("x"))) / F.count_if(word)).alias("words"))
    # Words and word pairs are as many as each other, so their mean is that of both kinds.
    llr = llr.select("row", (F.coalesce("shapes", F.lit(0.0)) + F.coalesce("words", F.lit(0.0))).alias("llr"))
    out = base_columns(rows).drop("t").join(llr, "row", "left").withColumn("llr", F.coalesce("llr", F.lit(0.0)))
    # Written, for a filter on kept would be pushed below the projections and repeat the array expressions many times over.
    out = materialize(out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)), "quality")
    return out.withColumnRenamed("row", row) if row else out.drop("row")


def _weights(spark, counts: DataFrame) -> DataFrame:
    """(b, x): log p_target/p_raw of each bucket: shapes, words, word pairs, ``BUCKETS`` of each kind.

    Shapes have one count added on both sides. The target of words is smoothed towards the raw corpus instead, so that a word
    that no trusted row has weighs against a text also where the trusted sample is small.
    """
    every = spark.range(0, 3 * BUCKETS, 1, 1).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left")
    every = every.select("b", F.floor(F.col("b") / BUCKETS).alias("kind"), *[F.coalesce(n, F.lit(0)).alias(n) for n in ("raw", "good")])
    total = every.groupBy("kind").agg(F.sum("raw").alias("raw_total"), F.sum("good").alias("good_total"))  # three rows
    p = (F.col("raw") + 1) / (F.col("raw_total") + BUCKETS)
    prior = F.when(F.col("kind") == 0, 1.0).otherwise(BUCKETS * p)
    x = F.log((F.col("good") + prior) / (F.col("good_total") + BUCKETS)) - F.log(p)
    return every.join(F.broadcast(total), "kind").select("b", x.alias("x"))


def grams(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per n-gram of ``t``: its bucket ``b``. Exploded rather than transformed, for lambdas are interpreted per element."""
    shapes = shape_buckets(rows, *keep).select(*keep, "b")
    words = word_buckets(rows, *keep).select(*keep, F.explode(F.array("u", "v")).alias("b"))
    return shapes.unionByName(words)


def word_buckets(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per word (run of letters, marks and digits, in lower case) of ``t``: its bucket ``u``, and ``v`` of it and the next word."""
    pairs = _pairs(rows, F.array_remove(F.split(F.lower("t"), "[^\\p{L}\\p{M}\\p{N}]+"), ""), *keep)
    bucket = lambda h, kind: (F.pmod(h, F.lit(BUCKETS)) + kind * BUCKETS).cast("int")
    x, n = F.col("p.x"), F.coalesce("p.n", F.lit("</s>"))
    return pairs.select(*keep, bucket(F.xxhash64(x), 1).alias("u"), bucket(F.xxhash64(x, n), 2).alias("v"))


def shape_buckets(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per word of ``t``: bucket ``b`` of its shape (runs of letters and digits folded) hashed with the next word's shape."""
    pairs = _pairs(rows, words_of(F.regexp_replace("t", "[\\p{L}\\p{N}]+", "a")), *keep)
    return pairs.select(*keep, F.pmod(F.xxhash64("p.x", F.coalesce("p.n", F.lit("</s>"))), F.lit(BUCKETS)).cast("int").alias("b"))


def _pairs(rows: DataFrame, words: Column, *keep: str) -> DataFrame:
    """One row per word: ``p`` of it (x) and the next (n, null behind the last)."""
    return rows.select(*keep, words.alias("w")).select(*keep, F.explode(F.arrays_zip(F.col("w").alias("x"), F.slice("w", 2, F.size("w")).alias("n"))).alias("p"))
