"""Registered queries against their SQL, and what the others promise on the smallest tables."""

import os

import pytest

from boardlake.llm import registry
from oracle import connection, differences

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_simhash": ["doc_id", "fingerprint", "component_id"],
    "op3_multi_index": ["query_id", "rank", "vec_id", "score"],
    "op4_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5_tokens": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op7_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op13_language": ["doc_id", "held_out", "lang_pred", "score"],
}


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, key):
    rows = QUERIES[key](spark, SF).toPandas()
    if key in ORACLES:
        assert differences(rows, connection(SF).execute(ORACLES[key]).df()) is None
    if key in COLUMNS:
        assert list(rows.columns)[: len(COLUMNS[key])] == COLUMNS[key]
        assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count() or key == "op3_multi_index"


def test_every_operator_is_registered():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)]
