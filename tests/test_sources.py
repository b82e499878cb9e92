"""Stores, keyed writes, models."""

import datetime

import pytest
from pyspark.sql import functions as F

from covista import jobs
from covista.operators import factors
from covista.operators.evaluate import correlations, hit_ratio, split_by_key
from covista.plans import scratch_path
from covista.sources import (
    export_factors,
    id_frame,
    index_rows,
    latest_version,
    load_latest_model,
    reuse,
    one_per_key,
    save_model,
    update_rows,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_keyed_writes(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None)], "id long, title string, score double")
    new = spark.createDataFrame([(2, 5.0, "v"), (3, 7.0, "v")], "id long, score double, version string")
    assert [tuple(r) for r in update_rows(old, new, "id").orderBy("id").collect()] == [
        (1, "a", 1.0, None), (2, "b", 5.0, "v")]
    fresh = spark.createDataFrame([(2, "x", 9.0), (4, "y", 1.0)], "id long, title string, score double")
    assert rows(index_rows(old, fresh, "id")) == [(1, "a", 1.0), (2, "x", 9.0), (4, "y", 1.0)]
    versions = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (2, 1, "one")], "id long, t long, v string")
    assert rows(one_per_key(versions, ["id"], ["t"])) == [(1, 9, "new"), (2, 1, "one")]


def test_id_frame(spark):
    assert rows(id_frame(spark, [3, 1], "user_id")) == [(1,), (3,)]


@pytest.fixture(scope="module")
def views(spark):
    return spark.range(400).select((F.col("id") % 20).alias("user_id"), ((F.col("id") * 7) % 31).alias("item_id"),
                                   F.timestamp_seconds("id").alias("event_time"))


def test_models(spark, views):
    root = scratch_path(spark, "models")
    with pytest.raises(FileNotFoundError):
        latest_version(spark, root)
    model = factors.train_implicit(views, batch_size=300, max_iter=2, rank=4, seed=1)
    save_model(model, root, datetime.datetime(2024, 1, 1))
    newest = save_model(model, root, datetime.datetime(2024, 2, 1))
    assert latest_version(spark, root) == newest
    loaded = load_latest_model(spark, root)
    assert rows(factors.items_for_all_users(loaded, 3)) == rows(factors.items_for_all_users(model, 3))
    exported = export_factors(model.itemFactors, model.uid)
    assert exported.columns == ["id", "model_factor", "model_version", "model_timestamp"]


def test_two_hops(spark):
    users = spark.createDataFrame([(1, 10, 2.0), (1, 11, 1.0)], "item_id long, user_id long, rating double")
    items = spark.createDataFrame([(10, 5, 3.0), (11, 5, 4.0), (11, 6, 1.0)], "user_id long, item_id long, rating double")
    assert rows(factors.two_hop(users, items)) == [(1, 5, 10.0), (1, 6, 1.0)]


def test_two_hops_move_lists(spark):
    """A user's items move to an item as one list; users and items with many rows are added up by rows."""
    users = spark.createDataFrame([(i, u, float(u)) for i in range(30) for u in range(i % 4, 40, 4)] + [(None, 1, 2.0), (3, None, 2.0)],
                                  "item_id long, user_id long, rating double")
    items = spark.createDataFrame([(u, o, float(o)) for u in range(50) for o in range(u % 3, 30, 3)] + [(None, 1, 1.0), (2, None, 2.0), (2, 4, None)],
                                  "user_id long, item_id long, rating double")
    plain = (users.withColumnRenamed("rating", "v").join(items.withColumnRenamed("item_id", "other_id"), "user_id")
             .groupBy("item_id", "other_id").agg(F.sum(F.col("v") * F.col("rating")).alias("score")))
    as_lists, as_rows = factors.two_hop(users, items), factors.two_hop(users, items, work_rows=10)
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(as_lists) == order(as_rows) == order(plain)
    text = as_lists._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(item_id" in text and "hashpartitioning(other_id" not in text.replace("item_id", "") and "collect_list" in text
    assert "collect_list" not in as_rows._jdf.queryExecution().executedPlan().toString()


def test_fits_on_views_clean_up_each_iteration(spark, views, monkeypatch):
    seen, fit = [], factors.ALS.fit
    monkeypatch.setattr(factors.ALS, "fit", lambda self, df: seen.append(self.getCheckpointInterval()) or fit(self, df))
    factors.train_implicit(views, max_iter=2, rank=2, seed=1)
    assert seen == [1]


def test_explicit_fits_join_and_add_up_once(spark, monkeypatch):
    lines = spark.createDataFrame([(u, i, o) for o, (u, i) in enumerate([(1, 1), (1, 2), (2, 1), (2, 1), (3, 2)])], "user_id long, item_id long, o long")
    amounts = spark.range(5).select(F.col("id").alias("o"), (F.col("id") + 1.0).alias("rating"))
    ratings = lines.join(amounts, "o").groupBy("user_id", "item_id").agg(F.sum("rating").alias("rating"))
    seen, fit = [], factors.ALS.fit
    monkeypatch.setattr(factors.ALS, "fit", lambda self, df: seen.append(df) or fit(self, df))
    model = factors.train_explicit(ratings, rank=2, max_iter=2)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange" not in plan and "Join" not in plan
    assert rows(seen[0]) == [(1, 1, 1.0), (1, 2, 2.0), (2, 1, 7.0), (3, 2, 5.0)]
    assert model.userFactors.count() == 3 and model.itemFactors.count() == 2


def test_merged_views_are_another_model(views):
    raw = factors.train_implicit(views, max_iter=2, rank=4, seed=1)
    merged = factors.train_implicit(views.union(views), max_iter=2, rank=4, seed=1, merge=True)
    assert raw.userFactors.count() == merged.userFactors.count()


def test_long_ids(spark):
    df = spark.createDataFrame([(3_000_000_000, 1), (7, 2), (3_000_000_000, 3)], "user_id long, item_id long")
    assert not factors.fits_int(df, "user_id") and factors.fits_int(df, "item_id")
    numbered, index = factors.with_int_ids(df, "user_id")
    assert dict(numbered.dtypes)["user_id"] == "int"
    back = numbered.join(index, numbered.user_id == index.idx).select("id", "item_id")
    assert rows(back) == [(7, 2), (3_000_000_000, 1), (3_000_000_000, 3)]


def test_cluster_mates(spark):
    clustered = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 0)], "item_id long, cluster int")
    assert rows(factors.first_cluster_mates(clustered, 1)) == [(1, 1, 2), (2, 1, 1), (4, 1, 1)]
    mates = factors.cluster_mates(clustered, id_frame(spark, [4], "item_id"))
    assert rows(mates) == [(4, 1), (4, 2), (4, 4)]


def test_evaluation(spark):
    test = spark.createDataFrame([(1, 1), (1, 1), (2, 5)], "user_id long, item_id long")
    recs = spark.createDataFrame([(1, 1), (1, 2), (2, 6)], "user_id long, item_id long")
    row = hit_ratio(test, recs).first()
    assert (row.hits, row.test_rows, row.test_pairs, row.hit_ratio, row.distinct_hit_ratio) == (1, 3, 2, 1 / 3, 0.5)
    assert hit_ratio(test.limit(0), recs).first().hit_ratio is None
    train, held = split_by_key(spark.range(5000), "id", 0.2)
    assert train.count() + held.count() == 5000 and 850 < held.count() < 1150
    pearson = correlations(spark.range(10).select("id", (-F.col("id")).alias("m")), ["id", "m"]).collect()
    assert {(r.left, r.right): round(r.pearson, 9) for r in pearson}["id", "m"] == -1


def test_jobs(spark, views):
    root, out = scratch_path(spark, "models"), scratch_path(spark, "lists")
    jobs.train(views, root, batch_size=400, max_iter=2, rank=4, seed=1)
    jobs.write_items_for_users(spark, root, f"{out}/users", 3)
    assert spark.read.parquet(f"{out}/users").count() == 20 * 3
    jobs.write_items_for_items(spark, root, f"{out}/items", 4)
    near = spark.read.parquet(f"{out}/items")
    assert near.count() == 31 * 4 and near.where("item_id = other_id").isEmpty()
    jobs.write_ranking(views, f"{out}/ranking")
    assert spark.read.parquet(f"{out}/ranking").agg({"ranking": "min"}).first()[0] == 1
    assert jobs.top_popular(views, 2).count() == 2
    jobs.write_cold_start(spark.range(18, 23).withColumnRenamed("id", "user_id"), views, f"{out}/cold", 2)
    assert rows(spark.read.parquet(f"{out}/cold").select("user_id").distinct()) == [(20,), (21,), (22,)]


def test_reuse(views):
    kept = reuse(views)
    assert kept.count() == 400 and kept.storageLevel.useMemory
    kept.unpersist()


def test_upserts_take_one_row_per_id(spark):
    from covista.sources import index_rows, update_rows

    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id int, name string, version int")
    new = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 1)], "id int, name string, version int")
    assert sorted(map(tuple, update_rows(old, new, "id", ["version"]).collect())) == [(1, "y", 2), (2, "b", 0)]
    assert sorted(map(tuple, index_rows(old, new, "id", ["version"]).collect())) == [(1, "y", 2), (2, "b", 0), (3, "z", 1)]


def test_upserted_versions(spark):
    from covista.plans import scratch_path
    from covista.sources import read_newest, upsert

    root = scratch_path(spark, "versions")
    upsert(spark, root, spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, name string"), "id")
    assert sorted(map(tuple, read_newest(spark, root).collect())) == [(1, "b"), (2, "c")]
    upsert(spark, root, spark.createDataFrame([(2, "d"), (3, "e")], "id int, name string"), "id")
    assert sorted(map(tuple, read_newest(spark, root).collect())) == [(1, "b"), (2, "d"), (3, "e")]
    upsert(spark, root, spark.createDataFrame([(3, 9), (4, 9)], "id int, n int"), "id", partial=True)
    assert sorted(map(tuple, read_newest(spark, root).collect())) == [(1, "b", None), (2, "d", None), (3, "e", 9)]


def test_kept_fits_and_factor_tables(spark):
    from covista import jobs
    from covista.plans import scratch_path
    from covista.sources import read_newest

    views = spark.createDataFrame([(u, i, f"2024-01-0{1 + (u + i) % 5} 00:00:00") for u in range(12) for i in range(8) if (u * i) % 3 != 1],
                                  "user_id bigint, item_id bigint, t string").selectExpr("user_id", "item_id", "CAST(t AS timestamp) AS event_time")
    root = scratch_path(spark, "fit")
    jobs.fit_similarity(views, root)
    jobs.write_similar_lists(spark, root, f"{root}/lists", 3)
    assert {r["rank"] for r in spark.read.parquet(f"{root}/lists").collect()} == {1, 2, 3}
    ratings = views.selectExpr("user_id + 5000000000 AS user_id", "item_id", "1.0 * (item_id % 5) AS rating")
    jobs.export_both_factors(ratings, f"{root}/users", f"{root}/items", rank=3, max_iter=2)
    users, items = (read_newest(spark, f"{root}/{name}") for name in ("users", "items"))
    assert {r["id"] for r in users.collect()} == {5000000000 + u for u in range(12)}
    assert all(len(r["model_factor"]) == 3 for r in items.collect())
