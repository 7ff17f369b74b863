"""Every registered query with check SQL agrees with DuckDB on the smallest tables."""

import pytest
from check import compare, connection

from conftest import FOLDER
from setstride.plans import ORACLES, QUERIES

SLOW_LEARNERS = {"tree_scores", "tree_importance", "forest_scores", "boosted_scores", "perceptron_scores", "forest_search"}


@pytest.fixture(scope="module")
def duck():
    return connection(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    note = compare((df.columns, rows), (columns, expected.fetchall()))
    assert note == "" or note.startswith("~"), note
    assert rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW_LEARNERS))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
