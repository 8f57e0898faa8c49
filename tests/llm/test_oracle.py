"""Queries of the operators that SQL can express against DuckDB, on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from ledgerloom.llm.queries import ORACLE, QUERIES
from tools.check_oracle import normal

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, key):
    db = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "conversations"):
        db.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    df = QUERIES[key](spark, SF)
    relation, cols = db.sql(ORACLE[key]), sorted(df.columns)
    assert sorted(relation.columns) == cols
    order = [relation.columns.index(c) for c in cols]
    got = Counter(tuple(normal(v) for v in row) for row in df.select(*cols).collect())
    assert got == Counter(tuple(normal(row[i]) for i in order) for row in relation.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "secrets", "mix"]
