from __future__ import annotations

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as contract

FOLDER = TESTDATA / "sf0.001"
KEYS = list(contract.registered.queries())


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(contract.oracle_sql())


@pytest.mark.skipif(not FOLDER.exists(), reason="no test data")
@pytest.mark.parametrize("key", KEYS)
def test_query_equals_oracle(spark, db, key):
    got = contract.queries()[key](spark, str(FOLDER))
    want = db.execute(contract.oracle_sql()[key])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    have = sorted(tuple(r) for r in got.select(*names).collect())
    assert have == sorted(want.fetchall())


@pytest.mark.skipif(not FOLDER.exists(), reason="no test data")
def test_entry(spark):
    assert contract.entry(spark).columns == ["score", "doc_id"]


@pytest.mark.skipif(not FOLDER.exists(), reason="no test data")
@pytest.mark.parametrize("key", ["common_words_sorted", "topk_common_words", "topk_documents"])
def test_order(spark, db, key):
    got = [tuple(r) for r in contract.queries()[key](spark, str(FOLDER)).collect()]
    assert got == db.execute(contract.oracle_sql()[key]).fetchall()
