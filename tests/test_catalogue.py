"""Every query with SQL against DuckDB on the same tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from lakeforge.operators import loads, windows


def _plain(v):
    if pd.isna(v):
        return None
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    return v.isoformat() if hasattr(v, "isoformat") else round(float(v), 4) if isinstance(v, (int, float)) or type(v).__name__ in ("int64", "int32", "float64", "Decimal") else str(v)


def _rows(frame):
    names = sorted(frame.columns)
    return names, sorted((tuple(_plain(v) for v in r) for r in frame[names].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, data, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    assert _rows(entry.queries()[name](spark, data).toPandas()) == _rows(con.sql(entry.oracle_sql()[name]).df())


def test_unknown_modes(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        windows.split_duplicates(df, ["id"], "some")
    with pytest.raises(ValueError):
        loads.load("sideways", df, df, ["id"])


def test_merge_rejects_repeated_source_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        loads.merge(t, s, ["k"]).collect()
