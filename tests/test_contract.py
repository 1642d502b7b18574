"""Every registered query against its SQL oracle at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = contract.SMOKE_DIR
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
# What an unchecked query must at least return.
COLUMNS = {
    "train_logistic": {"trial_id", "roc_auc"},
    "tune_trials": {"trial_id", "roc_auc"},
    "tune_constant_rate": {"trial_id", "roc_auc"},
    "score_batch": {"flight_id", "delay_prob"},
    "stream_score": {"flight_id", "delay_prob"},
}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return float(value) if isinstance(value, int) and not isinstance(value, bool) else value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(normal(r[i]) for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_oracle(spark, oracle, name):
    found = contract.queries()[name](spark, SF_DIR)
    result = oracle.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(names)
    expected = bag(names, result.fetchall())
    assert expected and bag(found.columns, found.collect()) == expected


def test_oracle_covers_all_but_the_trained_models():
    # The queries of the llm subpackage have tests of their own.
    own = {name for registry in contract.REGISTRIES for name in registry.queries}
    assert own - set(contract.oracle_sql()) == set(COLUMNS)


def test_trained_queries_return_rows(spark):
    # The other model queries run the same fits; one of them at this scale is enough here.
    rows = contract.queries()["score_batch"](spark, SF_DIR)
    assert COLUMNS["score_batch"] <= set(rows.columns)
    assert all(0 <= r.delay_prob <= 1 for r in rows.collect())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
