"""Lists of factor models by block products."""

import numpy as np
import pytest

from covista.operators import factors
from covista.plans import best_products, products


def table(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, vectors)], "id int, vector array<float>")


@pytest.mark.parametrize("blocks, share", [(1 << 24, 1 << 29), (6 * 40, 200)])
def test_best_products_against_all_pairs(spark, monkeypatch, blocks, share):
    monkeypatch.setattr(products, "SHARE", share)
    monkeypatch.setattr(products, "FIRST_ITEMS", 8)
    rng = np.random.default_rng(3)
    y = rng.normal(size=(150, 6)).astype(np.float32)
    y[20:60] = y[20]  # ties
    y[70] = 0
    x = rng.normal(size=(90, 6)).astype(np.float32)
    x[5], x[6:9] = 0, x[6]
    users, items = rng.permutation(10_000)[:90], rng.permutation(10_000)[:150]
    got = {}
    for r in best_products(table(spark, users, x), table(spark, items, y), 4, blocks).collect():
        got.setdefault(r["seed_id"], {})[r["rank"]] = (r["item_id"], r["score"])
    for u, v in zip(users, x.astype(float)):
        exact = sorted((-float((v * w).sum()), int(i)) for i, w in zip(items, y.astype(float)))
        assert [got[u][k] for k in (1, 2, 3, 4)] == [(i, -p) for p, i in exact[:4]] and len(got[u]) == 4


def test_lists_of_a_model(spark):
    """All lists at once, without a join of all pairs, and shorter where there are too few items."""
    rng = np.random.default_rng(4)
    views = spark.createDataFrame([(int(u) + 2**33, int(i)) for u, i in rng.integers(0, 12, (200, 2))], "user_id long, item_id long")
    model = factors.train_implicit(views, max_iter=2, rank=4, seed=1)
    lists = factors.items_for_all_users(model, 30)
    text = lists._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    users, items = ({r["id"]: np.array(r["features"], dtype=float) for r in f.collect()}
                    for f in (factors.user_factors(model), factors.item_factors(model)))
    got = [tuple(r) for r in lists.collect()]
    assert len(got) == len(users) * len(items) and {type(r[2]) for r in got} == {float}
    assert all(abs(users[u] @ items[i] - rating) < 1e-6 for u, i, rating, _ in got)
    some = factors.items_for_some_users(model, views.where("user_id % 2 = 0"), 3)
    assert sorted(map(tuple, some.collect())) == sorted(r for r in got if r[0] % 2 == 0 and r[3] <= 3)
    best = {r["item_id"]: (r["user_id"], r["rank"]) for r in factors.users_for_some_items(model, views.where("item_id = 1"), 1).collect()}
    assert set(best) == {1} and best[1][1] == 1
    assert max(r[2] for r in got if r[1] == 1) == next(r[2] for r in got if r[1] == 1 and r[0] == best[1][0])
