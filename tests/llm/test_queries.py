"""The registered queries: against DuckDB where SQL can express them, and their contracts."""

import duckdb
import pytest

import __spark_entry__ as contract
from sheetstar.llm.queries import ORACLES, QUERIES
from tests.test_queries import TABLES, _sorted_rows

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_all_are_registered():
    assert [n for n in QUERIES if n.startswith("op")] == sorted((n for n in QUERIES if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert len(QUERIES) == 14 and "pipeline" in QUERIES
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    ours, theirs = _sorted_rows(found.columns, found.collect()), _sorted_rows(columns, expected.fetchall())
    assert len(ours) == len(theirs) > 0
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not different, different[:3]


CONTRACTS = {
    "op1_projection_neighbours": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op2_word_backoff": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3_entropy_mix": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5_convolution_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_token_blocks": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op11_word_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op12_prefix_pieces": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op9_shingle_groups": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns_and_rows(spark, name):
    found = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert CONTRACTS[name].items() <= dict(found.dtypes).items()
    table = "embeddings" if name.startswith("op1_") else "documents"
    assert found.count() == spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").count()
