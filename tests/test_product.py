"""Best scores without the score matrix: brute force on skewed data, ties, negative factors, bounds that leave blocks out."""

import random

import pytest
from pyspark.sql import functions as F

from covista.operators import affinity as aff
from covista.operators import evaluate, product, recommend

A = "user_id long, item_id long, affinity double"
S = "item_id long, other_id long, similarity double"


def factors(seed, negative=False, users=40, items=90):
    """User 0 has viewed every item, item 0 was viewed by every user and is like all others; many values are equal."""
    rng = random.Random(seed)
    low = -4 if negative else 1
    a = {(u, i): rng.randrange(low, 5) / 4 for u in range(users) for i in range(items) if u == 0 or i == 0 or rng.random() < 0.05}
    s = {(i, j): rng.randrange(low, 4) / 2 ** rng.randrange(8) for i in range(items) for j in range(items)
         if 0 in (i, j) or rng.random() < 0.15}
    return a, s


def frames(spark, a, s):
    return (spark.createDataFrame([(*k, v) for k, v in a.items()], A),
            spark.createDataFrame([(*k, v) for k, v in s.items()], S))


def scores(a, s):
    rows = {}
    for (i, j), v in s.items():
        rows.setdefault(i, []).append((j, v))
    y = {}
    for (u, i), w in a.items():
        for j, v in rows.get(i, []):
            y[u, j] = y.get((u, j), 0.0) + w * v
    return y


def best(y, k, seen=()):
    users = {}
    for (u, j), v in y.items():
        if v != 0 and (u, j) not in seen:
            users.setdefault(u, []).append((-round(v, 9), j))
    return {(u, j) for u, rows in users.items() for _, j in sorted(rows)[:k]}


@pytest.mark.parametrize("negative, k, block_cells, user_cells", [(False, 5, 300, 100), (True, 5, 300, 100), (False, 500, 10**5, 10**5)])
def test_best_scores(spark, negative, k, block_cells, user_cells):
    a, s = factors(k, negative)
    y, how = scores(a, s), {"block_cells": block_cells, "user_cells": user_cells}
    rows = product.best_scores(*frames(spark, a, s), k, **how).collect()
    assert len(rows) == len({(r.user_id, r.item_id) for r in rows})
    assert {(r.user_id, r.item_id) for r in rows} == best(y, k)
    assert all(r.score == pytest.approx(y[r.user_id, r.item_id]) for r in rows)
    fa, fs = frames(spark, a, s)
    fresh = product.best_scores(fa, fs, k, users=fa.where("user_id < 7"), seen=fa.unionAll(fa), **how).collect()
    assert {(r.user_id, r.item_id) for r in fresh} == {p for p in best(y, k, a) if p[0] < 7}


def test_blocks_that_cannot_reach_the_list_are_left_out(spark, monkeypatch):
    """Columns of tiny similarity fill blocks of their own, which nobody with k better items visits."""
    s = {(i, j): 4.0 for i in range(10) for j in range(20)} | {(i, j): 2.0**-9 for i in range(10) for j in range(20, 400)}
    a = {(u, i): 1.0 for u in range(12) for i in range(10)}
    steps, store = [], product.stored

    def kept(df, label):
        out = store(df, label)
        if label == "steps":
            steps.extend(r._level for r in out.select("_level").distinct().collect())
        return out

    monkeypatch.setattr(product, "stored", kept)
    fa, fs = frames(spark, a, s)
    found = {(r.user_id, r.item_id) for r in product.best_scores(fa, fs, 20, block_cells=100).collect()}
    assert found == {(u, j) for u in range(12) for j in range(20)} and set(steps) == {2}
    steps.clear()
    assert product.best_scores(fa, fs, 21, block_cells=100).count() == 12 * 21 and set(steps) == {2, -9}


def test_empty_and_null_rows(spark):
    fa, fs = frames(spark, {(1, 1): 1.0}, {(1, 2): 3.0})
    assert product.best_scores(fa.limit(0), fs, 3).count() == 0
    assert product.best_scores(fa, fs.limit(0), 3).count() == 0
    nulls = spark.createDataFrame([(None, 1, 1.0), (1, None, 1.0), (1, 1, None)], A)
    more = fs.unionAll(spark.createDataFrame([(1, None, 9.0), (None, 2, 9.0), (1, 3, None), (1, 4, 0.0)], S))
    rows = product.best_scores(fa.unionAll(nulls).withColumn("_level", F.lit(1)), more, 3).collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3.0)]


@pytest.mark.parametrize("negative", [False, True])
def test_statistics_of_rows(spark, negative):
    fa, fs = frames(spark, *factors(3, negative))
    y = aff.predicted_scores(fa, fs)
    plain = {r.user_id: r for r in aff.user_score_stats(y, 90).collect()}
    mine = {r.user_id: r for r in product.score_stats(fa, fs, 90).collect()}
    assert plain.keys() == mine.keys()
    for u, r in mine.items():
        assert r.mean_score == pytest.approx(plain[u].mean_score) and r.max_score == pytest.approx(plain[u].max_score)
    test = spark.createDataFrame([(u, j) for u in range(45) for j in range(0, 95, 4)] * 2, "user_id long, item_id long")
    known = fa.select("user_id"), spark.range(90).select(F.col("id").alias("item_id"))
    one, two = evaluate.squared_miss(test, y, 90, *known).first(), evaluate.squared_miss_of(test, fa, fs, 90, *known).first()
    assert one[1:] == two[1:] and one.counted > 0 and one.error == pytest.approx(two.error)


@pytest.mark.parametrize("rules", [{}, {"include": ("a", "b"), "enhance": ("b",), "bias": 2.0}])
def test_lists_equal_those_of_all_scores(spark, rules):
    fa, fs = frames(spark, *factors(9))
    meta = spark.createDataFrame([(i, ["abc"[i % 3]]) for i in range(0, 100, 2)], "item_id long, filters array<string>")
    popular = spark.range(95).select(F.col("id").alias("item_id"), (F.col("id") % 7).cast("double").alias("popularity"))
    users = spark.range(45).select(F.col("id").alias("user_id"))
    banned = spark.createDataFrame([(0,), (4,)], "item_id long")
    rules |= {"metadata": meta, "exclude": banned, "seen": fa}
    whole = recommend.items_for_users(aff.predicted_scores(fa, fs), users, 6, popular, **rules)
    mine = recommend.lists_for_users(fa, fs, users, 6, popular, **rules)
    pick = [(r.user_id, r["rank"], r.item_id, r.source) for r in whole.collect()]
    assert sorted(pick) == sorted((r.user_id, r["rank"], r.item_id, r.source) for r in mine.collect()) and len(pick) > 200
