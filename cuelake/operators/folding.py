"""Order-dependent work on tracks: each track's rows in order, many tracks to a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..shipping import ship_package

#: Rows of a batch that goes back, about.
ROWS = 10_000


def in_rows(run: Callable[[dict], Iterable[tuple]]) -> Callable[[dict], Iterable[tuple]]:
    """A function that gives rows, as one that gives blocks of columns."""

    def blocks(track: dict):
        rows = list(run(track))
        return [tuple(zip(*rows))] if rows else []

    return blocks


def by_tracks(rows: DataFrame, run: Callable[[dict], Iterable[tuple]], schema: str, arrays: tuple[str, ...] = ()) -> DataFrame:
    """``run`` over every track: a dict of its columns in the order of ``pos``, to blocks of columns of ``schema`` without its first, the track.

    Columns come as lists with None for null, those named in ``arrays``, which must have no null, as NumPy arrays. Tracks follow each
    other in a partition and are told apart by their first rows, so that small ones cost no group of their own.
    """
    ship_package(rows.sparkSession)
    names = [c for c in rows.columns if c != "track_id"]
    first = F.row_number().over(W.partitionBy("track_id").orderBy("pos")) == 1
    rows = rows.select("track_id", first.alias("first"), *names)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def whole(parts: list[dict]) -> dict:
        if len(parts) == 1:
            return parts[0]
        return {n: np.concatenate([p[n] for p in parts]) if n in arrays else list(chain.from_iterable(p[n] for p in parts)) for n in names}

    def tracks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, dict]]:
        track, parts = None, []
        for b in batches:
            ids, starts = b.column(0).to_pylist(), np.flatnonzero(b.column(1).to_numpy(zero_copy_only=False)).tolist()
            columns = [c.to_numpy(zero_copy_only=False) if n in arrays else c.to_pylist() for n, c in zip(names, b.columns[2:])]
            before = starts[0] if starts else b.num_rows
            if before:
                parts.append({n: c[:before] for n, c in zip(names, columns)})
            for a, z in zip(starts, [*starts[1:], b.num_rows]):
                if parts:
                    yield track, whole(parts)
                track, parts = ids[a], [{n: c[a:z] for n, c in zip(names, columns)}]
        if parts:
            yield track, whole(parts)

    def column(parts: Iterable, kind: pa.DataType) -> pa.Array:
        return pa.array(np.concatenate(parts) if isinstance(parts[0], np.ndarray) else list(chain.from_iterable(parts)), kind)

    def batch(held: list[tuple]) -> pa.RecordBatch:
        ids = [[track] * len(block[0]) for track, block in held]
        return pa.RecordBatch.from_arrays([column(parts, f.type) for parts, f in zip([ids, *zip(*(block for _, block in held))], arrow)], schema=arrow)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for track, columns in tracks(batches):
            for block in run(columns):
                held.append((track, block))
                n += len(block[0])
                if n >= ROWS:
                    yield batch(held)
                    held, n = [], 0
        if n:
            yield batch(held)

    return rows.mapInArrow(work, schema)
