"""Every registered text query on empty tables and on tables with rows that are null in every column."""

from __future__ import annotations

import os

import pytest

from folia.llm import queries_llm

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(queries_llm.QUERIES))
def test_empty_tables_and_null_rows(spark, tmp_path_factory, name):
    empty, nulls = (str(tmp_path_factory.mktemp(n)) for n in ("empty", "nulls"))
    for table in ("project_regions", "source_selectors", "sources", "documents", "eval_items"):
        df = spark.read.parquet(f"{SMALL}/{table}.parquet")
        df.limit(0).write.parquet(f"{empty}/{table}.parquet")
        none = spark.createDataFrame([(None,) * len(df.columns)] * 2, df.schema)
        df.limit(5).unionByName(none).coalesce(1).write.parquet(f"{nulls}/{table}.parquet")
    assert queries_llm.QUERIES[name](spark, empty).collect() == []
    queries_llm.QUERIES[name](spark, nulls).collect()
