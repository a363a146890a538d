"""Every registered mutation query against its SQL in DuckDB, on the two smallest sets of tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from allelon.plans import files
from allelon.plans.queries import QUERIES
from allelon.plans.sql import ORACLE_SQL

SF = "/root/testdata/sf0.001"
SIZES = [SF, "/root/testdata/sf0.01"]


@pytest.fixture(scope="module")
def con():
    """A connection for each set of tables."""
    out = {}
    for sf in SIZES:
        out[sf] = duckdb.connect()
        for p in glob.glob(f"{sf}/*.parquet"):
            files_of = f"{p}/*.parquet" if os.path.isdir(p) else p
            out[sf].sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{files_of}')")
    return out


def value(x):
    if x is None or pd.isna(x):
        return None
    if isinstance(x, (bool,)) or type(x).__name__ == "bool_":
        return str(bool(x))
    return round(float(x), 6) if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(map(value, r)) for r in df[cols].astype(object).itertuples(index=False)), key=str)


def test_all_but_the_search_have_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == {"translated_search"} and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("sf", SIZES)
@pytest.mark.parametrize("name", sorted(files.QUERIES))
def test_files_equal_sql(spark, con, name, sf):
    assert rows(files.QUERIES[name](spark, sf).toPandas()) == rows(con[sf].sql(files.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("sf", SIZES)
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name, sf):
    assert rows(QUERIES[name](spark, sf).toPandas()) == rows(con[sf].sql(ORACLE_SQL[name]).df())


def test_search_finds_its_own_contigs(spark):
    found = {(r["gene"], r["contig_id"]): r["score"] for r in QUERIES["translated_search"](spark, SF).collect()}
    assert any(g == f"gene{c}" for g, c in found) and all(s > 0 for s in found.values())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
