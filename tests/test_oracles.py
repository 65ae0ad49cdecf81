"""Every query with SQL, at the smallest scale, against DuckDB."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from cuelake.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.execute(registry.oracle_sql()[name]).df()
    got = registry.queries()[name](spark, DATA).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_segments_cover_all_words(spark):
    got = registry.queries()["dp_segments"](spark, DATA).toPandas()
    assert len(got) and (got.chars <= 42).all() and (got.end - got.start <= 7 + 1e-6).all()
    for _, g in got.sort_values("idx").groupby("track_id"):
        assert g.word_start.iloc[0] == 0 and (g.word_start.iloc[1:].to_numpy() == g.word_end.iloc[:-1].to_numpy() + 1).all()
