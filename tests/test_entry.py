from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_registry():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and {"p1_found", "p4_found"} <= set(q)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
