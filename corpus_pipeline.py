"""Corpus pipeline: toxicity, quality rules, exact dedup, near-dedup, packing.

Stages take all rows their predecessor kept, decide on whole texts and keep rows as they are, extra columns included. Rows with a null
text count as empty, those with a null id are judged like any other, and of rows that repeat an id each is judged by itself.
A table without rows gives none. Toxicity is decided beside the row, without a shuffle; the other stages number the rows,
decide by that number, and join the decision to the text by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuelake.llm import exact_dedup, near_copies, packing, quality, toxicity
from cuelake.llm.queries import tokenizer
from cuelake.shipping import materialize


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a unique number each, and its column's name.

    Rows of a Parquet table are numbered by their file and their place in it, which hold however the table is split into tasks; any
    other plan is written first, for it may give its rows in another order when it runs again.
    """
    row, path, at = (_free(docs, name) for name in ("row_number", "row_file", "row_place"))
    plan = docs._jdf.queryExecution().analyzed()
    if plan.nodeName() != "LogicalRelation" or not plan.toString().rstrip().endswith(" parquet") or _free(docs, "_metadata") != "_metadata":
        return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row
    files = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())
    if not files:
        return docs.withColumn(row, F.lit(0).cast("long")), row
    names = docs.sparkSession.createDataFrame(list(enumerate(files)), f"{row} long, {path} string")
    placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(at)).join(F.broadcast(names), path)
    return placed.select(*(docs[c] for c in docs.columns), F.shiftleft(row, 40).bitwiseOR(F.col(at)).alias(row)), row


def _keep(docs: DataFrame, decided: DataFrame, row: str) -> DataFrame:
    """Rows whose number is among the kept ones of ``decided``; joined alike at any size, so that small tables tell what large ones take."""
    return docs.join(decided.where("kept").select(row).hint("merge"), row, "left_semi").drop(row)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is under 0.5, learned from the labels; null and empty texts have the score of no pattern."""
    grammar = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _free(docs, "score")
    return docs.withColumn(score, toxicity.probability(docs, grammar)).where(F.col(score) < 0.5).drop(score)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the ratio of trusted to raw n-grams; null, empty and very short texts fail."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs, row = _numbered(docs)
    return _keep(docs, quality.score(docs, labels.where("quality = 1"), row=row), row)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the smallest id, null ids last; of rows that repeat it, the first."""
    docs, row = _numbered(docs)
    return _keep(docs, exact_dedup.exact_groups(docs, row=row), row)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by five-word shingles of similarity 0.8 or more: the smallest id, null ids last."""
    docs, row = _numbered(docs)
    return _keep(docs, near_copies.near_groups(docs, row), row)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of token ids; every row is packed, empty texts as one end token."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("quality_rules", keep_quality), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
