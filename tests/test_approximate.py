"""Approximate neighbours against the exact search."""

import numpy as np
import pytest

from covista.plans import approximate, approximate_search, build_index, recall, search, stored, top_k
from covista.plans.approximate import cells_to_visit


def clustered(spark, n=1200, d=18):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(24, d)) * 4
    which = np.where(rng.random(n) < 1 / 3, 0, rng.integers(0, 24, n))  # one cluster holds a third
    rows = centres[which] + rng.normal(size=(n, d))
    rows[1] = rows[0]
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "item_id long, vector array<double>")
    return stored(df.unionAll(spark.createDataFrame([(n, None)], df.schema)), "clustered")


def test_recall_and_cells_visited(spark):
    items = clustered(spark)
    seeds = items.withColumnRenamed("item_id", "seed_id")
    exact = stored(search(seeds, items, 10, exclude_self=True), "exact")
    index = build_index(items)
    assert cells_to_visit(index, 10, 0.97, True) < len(index.centres) / 2  # clusters let most cells out
    found = stored(approximate_search(seeds, index, 10, exclude_self=True), "found")
    assert recall(found, exact).first()["recall"] >= 0.9
    costs = {(r["seed_id"], r["item_id"]): r["cost"] for r in exact.collect()}
    rows = found.collect()
    assert len({(r["seed_id"], r["rank"]) for r in rows}) == len(rows) and max(r["rank"] for r in rows) == 10
    assert all(costs[k] == pytest.approx(r["cost"]) for r in rows if (k := (r["seed_id"], r["item_id"])) in costs)
    assert all(r["seed_id"] != r["item_id"] for r in rows)


def test_all_cells_and_a_long_shortlist_are_exact(spark):
    items = clustered(spark)
    seeds = items.where("item_id % 20 = 0").withColumnRenamed("item_id", "seed_id")
    index = build_index(items, "cosine")
    # blocks of 100 codes: a hot cell is scored by several tasks
    found = approximate_search(seeds, index, 5, visits=len(index.centres), shortlist=240, block_rows=100)
    exact = search(seeds, items, 5, metric="cosine")
    assert sorted((r["seed_id"], r["rank"], r["item_id"]) for r in found.collect()) == \
        sorted((r["seed_id"], r["rank"], r["item_id"]) for r in exact.collect())


def test_seeds_move_once_a_block(spark, monkeypatch):
    """Blocks of several cells hand on k rows a seed, not a shortlist a cell."""
    items = clustered(spark)
    index, handed = build_index(items), []
    monkeypatch.setattr(approximate, "top_k", lambda df, *rest: handed.append(df.count()) or top_k(df, *rest))
    approximate_search(items.withColumnRenamed("item_id", "seed_id"), index, 3, visits=len(index.centres), exclude_self=True).count()
    assert handed == [1200 * 3]


def test_few_rows(spark):
    schema = "item_id long, vector array<double>"
    none = build_index(spark.createDataFrame([], schema))
    seeds = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "seed_id long, vector array<double>")
    assert approximate_search(seeds, none, 3).count() == 0
    few = build_index(spark.createDataFrame([(1, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [0.0, 0.0]), (9, None)], schema))
    rows = approximate_search(seeds, few, 5, visits=9).orderBy("rank").collect()
    assert [(r["item_id"], r["cost"]) for r in rows] == [(1, 0.0), (3, 0.0), (2, 1.0)]
    with pytest.raises(ValueError):
        build_index(spark.createDataFrame([], schema), "dot")
