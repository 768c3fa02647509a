"""Every array query runs, and agrees with its SQL in DuckDB over the same tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from voxelloom import bead_queries, plate_queries, queries  # noqa: F401

WHERE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        path = f"{WHERE}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')" if os.path.isdir(path) else f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _ordered(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].map(lambda v: isinstance(v, (list, tuple, np.ndarray))).any():
            df[c] = df[c].map(lambda v: None if v is None else str(np.asarray(v).tolist()))
        elif not pd.api.types.is_bool_dtype(df[c]):
            try:
                df[c] = df[c].astype(float)
            except (TypeError, ValueError):
                pass
    keys = [c for c in df.columns if c != "v"] + [c for c in df.columns if c == "v"]
    return df.sort_values(keys, na_position="first").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    got, want = _ordered(queries.QUERIES[name](spark, WHERE).toPandas()), _ordered(duck.execute(queries.ORACLE_SQL[name]).fetch_df())
    assert len(got) > 0
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=0, atol=2e-5)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, WHERE).count() > 0
