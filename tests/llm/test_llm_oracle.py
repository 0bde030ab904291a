"""Queries of the subpackage against their SQL twins."""

import glob
import os

import duckdb
import pytest

from conftest import plan
from veritally.llm.oracle import ORACLE
from veritally.llm.queries import QUERIES

NATIVE = ("op5_", "op6_", "op7_", "op9_", "op10_", "op12_")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def table(arrow, columns):
    return sorted((tuple(r[c] for c in columns) for r in arrow.to_pylist()), key=repr)


@pytest.mark.parametrize("name", ORACLE)
def test_same_rows(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir).toArrow()
    twin = duck.sql(ORACLE[name]).to_arrow_table()
    assert sorted(found.column_names) == sorted(twin.column_names)
    columns = sorted(found.column_names)
    for c in columns:
        assert str(found.schema.field(c).type) == str(twin.schema.field(c).type)
    assert table(found, columns) == table(twin, columns)


@pytest.mark.parametrize("name", QUERIES)
def test_plans(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name.startswith(NATIVE):
        assert not any(x in text for x in ("Python", "Arrow", "Pandas"))
