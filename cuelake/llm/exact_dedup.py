"""Operator 7: exact deduplication by tree-merging sorted digest runs.

Every partition holds a sorted run (digest, bytes, smallest id, rows). In round r a partition exchanges with the partners
whose numbers differ in digit r (base ``FAN``), each keeping the digests whose own digit r is its number; what arrives is
merged, so a group of copies shrinks to one row per partition at the first level and to one row at the last.
The answers go back by (leaf, digest), so no key carries more rows than there are leaves. The number of rounds follows from
the number of rows, so that a leaf has about ``LEAF_ROWS`` or fewer.

Null texts count as empty; empty texts are one group; a row with a null id stays only if its group has no other; of rows that
repeat the smallest id one stays; texts are hashed whole, however long; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..shipping import materialize, ship_package

FAN = 16
LEAF_ROWS = 2_000_000
_RUN = "part int, digest binary, n_bytes long, keep_id long, keep_row long, n long"


def _merge(batches):
    """One row per digest out of rows sorted by digest; equal digests of unequal length are an error."""
    held, rows = None, []
    for b in batches:
        for part, digest, size, keep, row, n in zip(*(b.column(i).to_pylist() for i in range(6))):
            if held and held[1] == digest and held[0] == part:
                if held[2] != size:
                    raise ValueError("digest collision")
                held[3:5] = min(held[3:5], [keep, row], key=lambda x: (x[0] is None, x[0], x[1]))
                held[5] += n
                continue
            if held:
                rows.append(held)
            held = [part, digest, size, keep, row, n]
            if len(rows) >= 8192:
                yield _batch(rows)
                rows = []
    if held:
        rows.append(held)
    if rows:
        yield _batch(rows)


def _batch(rows):
    kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "digest", "n_bytes", "keep_id", "keep_row", "n"])


def _round(runs: DataFrame, parts: int) -> DataFrame:
    return runs.repartition(parts, "part").sortWithinPartitions("part", "digest").mapInArrow(_merge, _RUN)


def exact_groups(docs: DataFrame, row: str | None = None, rounds: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, and the column ``row``, a unique number, where one is named."""
    spark = docs.sparkSession
    ship_package(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    number = F.col(row) if row else F.monotonically_increasing_id()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("row"), norm.alias("t"))
    rows = materialize(rows.select("doc_id", "row", F.unhex(F.sha2("t", 256)).alias("digest"), F.octet_length("t").cast("long").alias("n_bytes")), "digests")
    if rounds is None:
        rounds, n = 2, rows.count()
        while n > LEAF_ROWS * FAN**rounds:
            rounds += 1
    rows = rows.withColumn("leaf", F.pmod(F.xxhash64("row", F.lit(7)), F.lit(FAN**rounds)).cast("int"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    runs = rows.groupBy(F.col("leaf").alias("part"), "digest", "n_bytes").agg(first.alias("k"), F.count("*").alias("n"))
    runs = runs.select("part", "digest", "n_bytes", F.col("k.doc_id").alias("keep_id"), F.col("k.row").alias("keep_row"), "n")
    asked = runs.select(F.col("part").alias("leaf"), "digest")
    for r in range(rounds):
        digit = F.pmod(F.conv(F.hex(F.substring("digest", r + 1, 1)), 16, 10).cast("int"), F.lit(FAN))
        step = FAN**r
        own = F.floor(F.col("part") / step) % FAN
        runs = runs.withColumn("part", (F.col("part") + (digit - own) * step).cast("int"))
        runs = _round(runs, parts)
    merged = runs.select("digest", "keep_id", "keep_row", F.col("n").alias("group_size"))
    answer = asked.join(merged, "digest")
    out = rows.join(answer, ["leaf", "digest"])
    named = [F.col("row").alias(row)] if row else []
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), *named)
