"""Every registered query against its SQL twin on the same tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points

from conftest import plan

UNPARTITIONED = re.compile(r"windowspecdefinition\((\w+)#\w+ (?:ASC|DESC)")
# Plan steps that no query may have: Python workers and joins of everything with everything.
UNWANTED = ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")
from veritally.verification.oracle import ORACLE  # noqa: E402
from veritally.verification.registry import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{sf_dir}/{name}'")
    return con


BRANCHES = {
    "score_rollouts_shuffled": ("SortMergeJoin", None),
    "score_rollouts_hot": ("_salt", None),
    "broadcast_advantage_long": ("_salt", None),
    "vocab_encode_short_head": ("SortMergeJoin", None),
    "score_rollouts": ("BroadcastHashJoin", "_salt"),
}


@pytest.mark.parametrize("name", BRANCHES)
def test_the_wanted_branch_is_taken(spark, sf_dir, name):
    steps = plan(QUERIES[name](spark, sf_dir))
    there, absent = BRANCHES[name]
    assert there in steps and (absent is None or absent not in steps)


def text(v):
    if isinstance(v, list):
        return "[" + ",".join(text(x) for x in v) + "]"
    return repr(v)


def table(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(text(r[i]) for i in order) for r in records)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    steps = plan(df)
    assert not [step for step in UNWANTED if step in steps]
    # A window without a partition sees counts per bucket or block of buckets, never rows of a table.
    assert {m[1] for m in UNPARTITIONED.finditer(steps)} <= {"_bucket", "_block"}
    found = df.toArrow()
    twin = duck.sql(ORACLE[name]).to_arrow_table()
    assert sorted(found.column_names) == sorted(twin.column_names)
    for f in found.schema:
        assert str(f.type).replace(" not null", "").replace("element", "l") == str(twin.schema.field(f.name).type)
    mine = zip(*(c.to_pylist() for c in found.columns))
    theirs = zip(*(c.to_pylist() for c in twin.columns))
    assert table(found.column_names, mine) == table(twin.column_names, theirs)
