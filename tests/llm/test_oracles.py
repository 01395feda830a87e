"""The queries that SQL can express against DuckDB, on the smallest tables with hard rows added."""

from __future__ import annotations

import os

import duckdb
import pytest

from contact_mart.llm.oracles import ORACLES
from contact_mart.llm.queries import QUERIES

from .conftest import SF

TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_duckdb(spark, corpus, name):
    # Conversations have no hard rows of their own; test_prefix_trie.py has.
    given = os.environ.get("ORACLE_SF_DIR")
    folder = given or (SF if name == "op13_prefix_trie" else corpus)
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    ours, theirs = QUERIES[name](spark, folder), duck.sql(ORACLES[name])
    order = sorted(ours.columns)
    assert order == sorted(theirs.columns)
    assert dict(ours.dtypes) == {c: TYPES[str(t)] for c, t in zip(theirs.columns, theirs.types)}
    at = [theirs.columns.index(c) for c in order]
    got = sorted((tuple(r) for r in ours.select(*order).collect()), key=repr)
    wanted = sorted((tuple(r[i] for i in at) for r in theirs.fetchall()), key=repr)
    assert [(g, w) for g, w in zip(got, wanted) if g != w][:3] == []
    assert len(got) == len(wanted) > 0
