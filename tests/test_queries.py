"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from suite import factors
from tests.oracle import connection, difference

FOLDER = "/root/testdata/sf0.001"


def built(spark, name):
    """The query's frame, after a look at its plan: no cross join, no row-at-a-time Python."""
    df = entry.queries()[name](spark, FOLDER)
    if not name.startswith("als_"):  # MLlib pairs blocks of factors by itself
        text = df._jdf.queryExecution().executedPlan().toString()
        assert not any(n in text for n in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"))
    return df


@pytest.fixture(scope="module")
def duck():
    return connection(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    assert difference(built(spark, name), duck, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_gives_rows(spark, name):
    assert built(spark, name).count() > 0


def test_long_ids_are_fitted_with_all_factors(spark, monkeypatch):
    ranks, train = [], factors.ops.train_implicit

    def fit(df, **how):
        model = train(df, **how)
        ranks.append(model.rank)
        return model

    monkeypatch.setattr(factors.ops, "train_implicit", fit)
    entry.queries()["als_lists_of_long_ids"](spark, FOLDER)
    assert ranks == [50]


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
