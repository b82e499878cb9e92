"""Tables and fits that grow: bucketed upserts, affinity states, relocation maps, co-occurrence."""

import pytest
from pyspark.sql import functions as F

from covista.operators import affinity as aff
from covista.operators import cooccurrence as cooc
from covista.operators import space
from covista.operators.counts import distinct_pairs
from covista.plans import scratch_path, stored
from covista.sources import read_buckets, upsert_buckets


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(df):
    return set(df.inputFiles())


def test_untouched_buckets_keep_their_files(spark):
    root = scratch_path(spark, "buckets")
    first = spark.range(1000).selectExpr("id", "'old' AS state", "id AS version")
    assert upsert_buckets(spark, root, first, "id", buckets=32) == 1
    before = read_buckets(spark, root)
    old = files(before)
    assert rows(before) == [(i, "old", i) for i in sorted(range(1000), key=lambda i: repr((i, "old", i)))]
    new = spark.createDataFrame([(7, "a", 1), (7, "b", 2), (5000, "c", 3)], "id int, state string, version long")
    assert upsert_buckets(spark, root, new, "id", ["version"]) == 2
    after = read_buckets(spark, root)
    assert len(files(after) - old) <= 2 and len(files(after) & old) >= 30
    got = {r["id"]: r["state"] for r in after.collect()}
    assert len(got) == 1001 and after.count() == 1001 and got[7] == "b" and got[5000] == "c" and got[8] == "old"
    assert rows(before) == [(i, "old", i) for i in sorted(range(1000), key=lambda i: repr((i, "old", i)))]  # readers keep theirs


def test_partial_updates_bring_columns(spark):
    root = scratch_path(spark, "buckets")
    upsert_buckets(spark, root, spark.range(100).selectExpr("id", "id * 2 AS x"), "id", buckets=8)
    upsert_buckets(spark, root, spark.createDataFrame([(3, "v"), (999, "w")], "id long, tag string"), "id", partial=True)
    got = {r["id"]: (r["x"], r["tag"]) for r in read_buckets(spark, root).collect()}
    assert len(got) == 100 and got[3] == (6, "v") and got[4] == (8, None)
    ids = spark.createDataFrame([(3,), (50,), (12345,)], "id long")
    assert rows(read_buckets(spark, root, "id", ids).select("id", "x", "tag")) == [(3, 6, "v"), (50, 100, None)]
    assert len(read_buckets(spark, root, "id", ids).inputFiles()) <= 4


def test_empty_and_incomplete_tables(spark):
    root = scratch_path(spark, "buckets")
    with pytest.raises(FileNotFoundError):
        read_buckets(spark, root)
    none = spark.createDataFrame([], "id long, x long")
    upsert_buckets(spark, root, none, "id", buckets=4)
    assert read_buckets(spark, root).count() == 0
    # rows of a version without a manifest are a lost upsert: not seen, and overwritten by the next
    spark.range(5).selectExpr("id", "id AS x", "0 AS covista_bucket").write.partitionBy("covista_bucket").parquet(f"{root}/rows/covista_version=2")
    assert read_buckets(spark, root).count() == 0
    upsert_buckets(spark, root, spark.createDataFrame([(1, 2)], "id long, x long"), "id")
    assert rows(read_buckets(spark, root)) == [(1, 2)]
    upsert_buckets(spark, root, none, "id")
    assert rows(read_buckets(spark, root)) == [(1, 2)]


def events(spark):
    made = [(u, (u * i) % 7, f"2024-01-{1 + (3 * u + 5 * i) % 28:02d} 0{i % 10}:00:00") for u in range(9) for i in range(u + 1)]
    return stored(spark.createDataFrame(made, "user_id long, item_id long, t string")
                  .select("user_id", "item_id", F.col("t").cast("timestamp").alias("event_time")), "events")


def parts(df):
    day = F.dayofmonth("event_time")
    return [df.where(w) for w in (day < 6, (day >= 6) & (day < 15), day >= 15, day > 40)]


def test_states_merge_in_any_order(spark):
    df = events(spark)
    whole = {(r["user_id"], r["item_id"]): r["affinity"] for r in aff.affinity(df, half_life=86400.0).collect()}
    a, b, c, none = (aff.affinity_state(p, 86400.0) for p in parts(df))
    for state in (aff.merged_states(c, aff.merged_states(a, b, half_life=86400.0), half_life=86400.0),
                  aff.merged_states(none, b, c, a, half_life=86400.0)):
        got = {(r["user_id"], r["item_id"]): r["affinity"] for r in aff.affinity_of(state).collect()}
        assert got.keys() == whole.keys() and all(got[k] == pytest.approx(v, rel=1e-9) for k, v in whole.items())
    later = aff.affinity_of(aff.affinity_state(df, 86400.0), aff.affinity_state(df).first()["at"] + 86400, 86400.0)
    assert all(r["affinity"] == pytest.approx(whole[r["user_id"], r["item_id"]] / 2) for r in later.collect())


@pytest.mark.parametrize("alpha", [0.0, 0.6, 1.0])
def test_moves_compose(spark, alpha):
    df = events(spark)
    items = spark.createDataFrame([(i, [float(i), 1.0 / (i + 1)]) for i in range(6)], "item_id long, vector array<double>")
    users = spark.createDataFrame([(0,), (77,)], "user_id long")
    whole = {r["user_id"]: r["vector"] for r in space.relocated_users(df, items, alpha, users).collect()}
    a, b, c, none = (space.relocation_state(p, items, alpha) for p in parts(df))
    for state in (space.composed(space.composed(a, b, alpha), space.composed(c, none, alpha), alpha),
                  space.composed(a, space.composed(space.composed(none, b, alpha), c, alpha), alpha)):
        got = {r["user_id"]: r["vector"] for r in space.placed_by(state, items, alpha, users).collect()}
        assert got.keys() == whole.keys() and all(got[u] == pytest.approx(v, abs=1e-12) for u, v in whole.items())
    # the loop itself
    vectors, mean = {r["item_id"]: r["vector"] for r in items.collect()}, [2.5, sum(1 / (i + 1) for i in range(6)) / 6]
    for u, v in whole.items():
        x = mean
        for r in sorted(df.where(F.col("user_id") == u).collect(), key=lambda r: (r["event_time"], r["item_id"])):
            if r["item_id"] in vectors:
                x = [p + alpha * (q - p) for p, q in zip(x, vectors[r["item_id"]])]
        assert v == pytest.approx(x, abs=1e-9)


@pytest.mark.parametrize("hot", [0, 60])
def test_cells_extend(spark, hot):
    df = events(spark).select("user_id", "item_id")
    if hot:
        df = df.unionAll(spark.range(hot).selectExpr("1000L AS user_id", "id AS item_id"))
    whole = rows(cooc.cooccurrence(distinct_pairs(df)).select("item_id", "other_id", "both"))
    side = F.pmod(F.xxhash64("item_id", "user_id"), F.lit(4))
    pairs = stored(distinct_pairs(df.where(side == 0)), "pairs")
    cells = stored(cooc.cooccurrence(pairs), "cells")
    for k in ([1, 0], [2, 3], [9]):  # known pairs among the new, and nothing at all
        cells, pairs = cooc.extended_cooccurrence(cells, pairs, df.where(side.isin(k)))
        cells, pairs = stored(cells, "cells"), stored(pairs, "pairs")
    assert rows(cells.select("item_id", "other_id", "both")) == whole
    assert rows(pairs.select("user_id", "item_id")) == rows(df.distinct())


def test_draws_do_not_depend_on_partitions(spark):
    from covista.operators.counts import drawn, random_item

    df = spark.range(500).selectExpr("id % 90 AS item_id").unionAll(spark.createDataFrame([(None,)], "item_id long"))
    for seed in (1, 2):
        ones = {random_item(df.repartition(k), seed).first()["item_id"] for k in (1, 7)}
        some = {tuple(r["item_id"] for r in drawn(df.repartition(k), "item_id", 5, seed).collect()) for k in (1, 7)}
        assert len(ones) == len(some) == 1 and next(iter(some))[0] in ones
    assert random_item(df).count() == 1 and random_item(df.limit(0), 1).count() == 0
    assert len({random_item(df, seed).first()["item_id"] for seed in range(8)}) > 3
