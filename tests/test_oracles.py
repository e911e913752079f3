"""Registered queries of the core: on empty tables and null rows, and against their SQL on small tables.

All of them with SQL are compared if FOLIA_ALL_SQL is set, else one of each kind.
"""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pytest

from folia import queries_audit, queries_core, queries_layout, queries_ledgers, queries_reference, queries_reports, queries_sources

SMALL = "/root/testdata/sf0.001"
MODULES = (queries_core, queries_reference, queries_layout, queries_reports, queries_sources, queries_ledgers, queries_audit)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: q for m in MODULES for k, q in m.SQL.items()}

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


def cell(x):
    if x is None or (not hasattr(x, "__len__") and pd.isna(x)):
        return None
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, list):
        return tuple(map(cell, x))
    return round(float(x), 9) if isinstance(x, float) else x


def rows(df: pd.DataFrame):
    return sorted((tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.fixture(scope="session")
def small():
    con = duckdb.connect()
    for f in glob.glob(SMALL + "/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.fixture(scope="session")
def dirty(spark, tmp_path_factory):
    """Two folders: all tables without rows, and with a few rows of which two are null in every column."""
    empty, nulls = (str(tmp_path_factory.mktemp(n)) for n in ("empty", "nulls"))
    for f in glob.glob(SMALL + "/*.parquet"):
        df = spark.read.parquet(f)
        df.limit(0).write.parquet(f"{empty}/{os.path.basename(f)}")
        none = spark.createDataFrame([(None,) * len(df.columns)] * 2, df.schema)
        df.limit(5).unionByName(none).coalesce(1).write.parquet(f"{nulls}/{os.path.basename(f)}")
    return empty, nulls


SOME = ["p1_found", "p1_intervals", "p4_found", "cer_by_engine", "region_kind", "reading_graph", "engine_report", "reconcile_findings", "source_blocks", "guarded_patch_apply", "edge_recall"]


@pytest.mark.parametrize("name", sorted(SQL) if os.environ.get("FOLIA_ALL_SQL") else SOME)
def test_equal_to_sql(spark, small, name):
    got, want = QUERIES[name](spark, SMALL).toPandas(), small.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_and_null_rows(spark, dirty, name):
    empty, nulls = dirty
    got = QUERIES[name](spark, empty).collect()
    # What counts named things gives a row for each of them.
    assert all(all(not isinstance(v, (int, float)) or not v for k, v in r.asDict().items() if k not in ("required", "missing")) for r in got), got[:3]
    QUERIES[name](spark, nulls).collect()
