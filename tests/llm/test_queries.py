from __future__ import annotations

import pytest

from palabre.llm.queries import ORACLES, QUERIES
from tests.oracle import SF_DIR, compare

SAME_ROWS = ["op2", "op3", "op4", "op6", "op7", "op8", "op9", "op10"]


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    assert compare(spark, SF_DIR, QUERIES[key], ORACLES[key]) > 0


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_query_answers_for_every_row(spark, key):
    own = {"op1": ("pages", "page_id"), "op12": ("embeddings", "vec_id")}
    table, id_ = own.get(key.split("_")[0], ("documents", "doc_id"))
    want = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    got = QUERIES[key](spark, SF_DIR).select(id_)
    assert got.distinct().count() == want.count()
    if key.split("_")[0] in SAME_ROWS:
        assert got.count() == want.count()
