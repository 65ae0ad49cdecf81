"""Operator 8: speculate-and-verify byte-pair encoding and decoding."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..shipping import ship_package
from .tokens import SpeculativeBpe, loaded


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of whole texts; a null text counts as empty, repeated rows and null ids stay."""
    ship_package(docs.sparkSession)

    def run(batches):
        bpe = loaded(SpeculativeBpe, path)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                s = b.slice(i, 256)
                ids = bpe.encode_batch(s.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([s.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("t")).mapInArrow(run, "doc_id long, ids array<int>")


def encode_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass, keeping digests only, so that id arrays need not cross to the JVM."""
    ship_package(docs.sparkSession)

    def run(batches):
        bpe = loaded(SpeculativeBpe, path)
        number = list(map(str, range(bpe.size)))
        for b in batches:
            for i in range(0, b.num_rows, 256):
                s = b.slice(i, 256)
                ids = bpe.encode_batch(s.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        s.column(0),
                        pa.array(map(len, ids), pa.int64()),
                        pa.array([hashlib.sha256(" ".join(map(number.__getitem__, x)).encode()).hexdigest() for x in ids], pa.string()),
                        pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return source.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
