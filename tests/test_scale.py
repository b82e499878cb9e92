"""The ways around skew must give the plain results: brute force on small data with hot keys."""

import datetime
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from covista.operators import cooccurrence as cooc
from covista.operators import affinity as aff
from covista.operators import counts, recommend, space, vectors
from covista.operators.catalogue import append_index
from covista.plans import fan_out_join, first_rows, search, top_k, with_ordinal
from covista.plans.search import _by_cells
from covista.plans.skew import hot_keys


@pytest.fixture(scope="module")
def skewed():
    """(user, item, second) rows; user 0 has a third of them, item 0 a third as well."""
    rng = random.Random(5)
    rows = [(0, rng.randrange(150)) for _ in range(400)] + [(rng.randrange(60), 0) for _ in range(400)]
    rows += [(rng.randrange(60), rng.randrange(150)) for _ in range(400)]
    return [(u, i, rng.randrange(10**6)) for u, i in rows]


@pytest.fixture(scope="module")
def events(spark, skewed):
    df = spark.createDataFrame(skewed, "user_id long, item_id long, s long")
    return df.select("user_id", "item_id", F.timestamp_seconds("s").alias("event_time"))


def test_hot_keys_count_the_rows_of_both_sides(spark):
    df = spark.range(10_000).select((F.col("id") % 1000).alias("k"))
    assert hot_keys(df, df, ["k"], 100).count() == 0
    assert hot_keys(df.where("k < 5"), df, ["k"], 99).count() == 5
    right = spark.range(4_000).select((F.col("id") % 2).alias("k"))
    assert [tuple(r) for r in hot_keys(df.where("k = 0"), right, ["k"], 1_000).collect()] == [(0, 1, 20)]


@pytest.mark.parametrize("work_rows", [10, 100_000])
def test_fan_out_join(events, skewed, work_rows):
    right = events.select("item_id", F.col("user_id").alias("other"))
    rows = fan_out_join(events.select("user_id", "item_id"), right, ["item_id"], ["user_id"], work_rows)
    mine = sorted((r.user_id, r.item_id, r.other) for r in rows.collect())
    by_item = {}
    for u, i, _ in skewed:
        by_item.setdefault(i, []).append(u)
    assert mine == sorted((u, i, v) for i, users in by_item.items() for u in users for v in users)


@pytest.mark.parametrize("block", [4, 7, 1024])
def test_cooccurrence_blocks(events, skewed, block):
    histories = {}
    for u, i, _ in skewed:
        histories.setdefault(u, set()).add(i)
    expected = {}
    for items in histories.values():
        for a, b in itertools.product(items, items):
            expected[a, b] = expected.get((a, b), 0) + 1
    cells = cooc.cooccurrence(counts.distinct_pairs(events), history_block=block).collect()
    assert len(cells) == len(expected) and {(r.item_id, r.other_id): r.both for r in cells} == expected


def test_consistency_check_finds_errors(events):
    pairs = counts.distinct_pairs(events)
    cells = cooc.cooccurrence(pairs)
    good = cooc.consistency_check(pairs, cells).first()
    assert good[1:] == (0, 0, 0)
    one = F.when((F.col("item_id") == 0) & (F.col("other_id") == 1), F.col("both") + 1).otherwise(F.col("both"))
    bad = cooc.consistency_check(pairs, cells.withColumn("both", one)).first()
    assert (bad.mismatches, bad.asymmetric, bad.wrong_diagonal) == (1, 2, 0)


def test_scores_with_hot_item(events):
    pairs = counts.distinct_pairs(events)
    a, s = aff.affinity(events, half_life=3e5), cooc.item_similarity(cooc.cooccurrence(pairs), "jaccard")
    plain = {(r.user_id, r.item_id): r.score for r in aff.predicted_scores(a, s).collect()}
    salted = {(r.user_id, r.item_id): r.score for r in aff.predicted_scores(a, s, work_rows=5).collect()}
    assert plain.keys() == salted.keys() and all(salted[k] == pytest.approx(v) for k, v in plain.items())
    wanted = pairs.limit(50)
    for r in aff.score_lookup(a, s, wanted, work_rows=5).collect():
        assert r.score == pytest.approx(plain[r.user_id, r.item_id])


@pytest.mark.parametrize("k", [3, 1500])
def test_top_k(spark, k):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5).alias("g"),
                                  ((F.col("id") * 7919) % 9001).alias("v"))
    mine = top_k(df, ["g"], [F.desc("v")], k).collect()
    rows = {}
    for r in df.collect():
        rows.setdefault(r.g, []).append(r.v)
    expected = {(g, n + 1): v for g, values in rows.items() for n, v in enumerate(sorted(values, reverse=True)[:k])}
    assert {(r.g, r["rank"]): r.v for r in mine} == expected


@pytest.mark.parametrize("n, newest", [(1, True), (37, True), (37, False), (5000, True)])
def test_first_rows(spark, n, newest):
    rows = [(i, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=(i * 37) % 400)) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, t timestamp")
    mine = [r.id for r in first_rows(df, "t", n, ["id"], newest).collect()]
    expected = sorted(rows, key=lambda r: (-r[1].timestamp() if newest else r[1].timestamp(), r[0]))[:n]
    assert mine == [r[0] for r in expected]


def test_ordinals(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("id")).repartition(7)
    rows = sorted((r.id, r.n) for r in with_ordinal(df, ["id"], "n", 5).collect())
    assert [n for _, n in rows] == list(range(5, 1005))
    index = append_index(spark.createDataFrame([(3, 0), (9, 1)], "id long, idx long"),
                         spark.createDataFrame([(9,), (1,), (40,), (2**40,)], "id long"))
    assert {r.id: r.idx for r in index.collect()} == {3: 0, 9: 1, 1: 2, 40: 3, 2**40: 4}


def test_lists_in_parts(events, skewed):
    lists = counts.viewer_sets(counts.distinct_pairs(events), list_rows=10).collect()
    expected = {}
    for u, i, _ in skewed:
        expected.setdefault(i, set()).add(u)
    merged = {}
    for r in lists:
        merged.setdefault(r.item_id, []).extend(r.viewers)
    assert max(r.part for r in lists) > 0
    assert {i: sorted(v) for i, v in merged.items()} == {i: sorted(v) for i, v in expected.items()}


@pytest.fixture(scope="module")
def cloud():
    """300 vectors in clusters; a third are copies of one vector, one is zero."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 4
    x = centres[rng.integers(0, 6, 300)] + rng.normal(size=(300, 8)) * 0.3
    x[:100] = x[0]
    x[299] = 0
    return x


@pytest.mark.parametrize("metric", ["euclidean", "cosine", "dot"])
@pytest.mark.parametrize("tuning", [{}, {"few_seeds": 3, "cell_rows": 20, "block_values": 8 * 25}, {"few_seeds": 1000}])
@pytest.mark.parametrize("exclude_self", [True, False])
def test_search(spark, cloud, metric, tuning, exclude_self):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(cloud)]
    items = spark.createDataFrame(rows + [(1000, None)], "item_id long, vector array<double>")
    hits = search(items.withColumnRenamed("item_id", "seed_id"), items, k=7, metric=metric, exclude_self=exclude_self, **tuning)
    mine = {}
    for r in sorted(hits.collect(), key=lambda r: (r.seed_id, r["rank"])):
        mine.setdefault(r.seed_id, []).append((r.item_id, round(r.cost, 6) + 0.0))
    x = cloud
    if metric == "cosine":
        length = np.linalg.norm(x, axis=1, keepdims=True)
        x = x / np.where(length == 0, 1, length)
    assert len(mine) == 300
    for i, q in enumerate(x):
        cost = np.sqrt(((x - q) ** 2).sum(1)) if metric == "euclidean" else -(x @ q)
        order = [int(j) for j in np.lexsort((np.arange(len(x)), np.round(cost, 9))) if j != i or not exclude_self][:7]
        assert [c for _, c in mine[i]] == pytest.approx([round(float(cost[j]), 6) for j in order], abs=2e-6)
        assert [j for j, _ in mine[i]] == order


@pytest.mark.parametrize("block", [5, 1024])
def test_half_cells_at_items(spark, block):
    """Both ways of counting give the same cells; a pair is counted at its item with fewer viewers, from one array a viewer."""
    rng = np.random.default_rng(4)
    rows = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 40, 500), rng.zipf(1.5, 500) % 60)})
    pairs = spark.createDataFrame(rows, "user_id long, item_id long")
    maps, items = (sorted(map(tuple, cooc.half_cells(pairs, block, True, way).collect())) for way in (False, True))
    assert maps == items and len(maps) > 100
    assert sorted(map(tuple, cooc.half_cells(pairs, block).collect())) == [(a, b, n) for a, b, _, _, n in maps]
    plan = cooc.half_cells(pairs, block, False, True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(one#" in plan and not re.search(r"hashpartitioning\([^)]*two#", plan)  # no row per pair is shuffled


@pytest.mark.parametrize("far, kind", [(0, "tinyint"), (5000, "smallint"), (2**31 - 200, "int"), (2**40, "bigint"), (-(2**40), "bigint")])
def test_partners_move_in_narrow_types(spark, far, kind):
    """Arrays of partners hold ids in the smallest type that takes them all; the cells have the ids' own type."""
    rows = [(u, i) for u in range(12) for i in range(100) if (u * 7 + i) % 5 == 0] + [(None, 3), (3, None)]
    plain, moved = (cooc.half_cells(spark.createDataFrame([(u, i if i is None else i + d) for u, i in rows], "user_id long, item_id long"),
                                    1024, True, True) for d in (0, far))
    assert moved.dtypes == plain.dtypes == [(c, "bigint") for c in ("item_id", "other_id", "viewers", "other_viewers", "both")]
    assert sorted(map(tuple, moved.collect())) == sorted((a + far, b + far, *rest) for a, b, *rest in plain.collect())
    found = set(re.findall(r"cast\(item_id#\d+L as (\w+)\)", moved._jdf.queryExecution().executedPlan().toString()))
    assert found == ({kind} if kind != "bigint" else set())


def test_seeds_move_once_a_block(spark):
    """Vectors without clusters, where no cell can be left out: a block of many cells hands on k rows a seed, not k a cell."""
    x = np.random.default_rng(9).normal(size=(300, 16))
    items = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "item_id long, vector array<double>")
    seeds = items.withColumnRenamed("item_id", "seed_id")
    handed = [_by_cells(seeds, items, 7, None, "euclidean", True, values, 10).count() for values in (16 * 300, 16 * 100)]
    assert handed[0] == 300 * 7 and handed[1] <= 300 * 7 * 5  # the second in 3 blocks, or a few more where cells don't fit


@pytest.mark.parametrize("tuning", [{}, {"few_seeds": 3, "cell_rows": 20, "block_values": 8 * 25}])
def test_radius(spark, cloud, tuning):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(cloud)]
    points = spark.createDataFrame(rows, "id long, vector array<double>").withColumn("type", F.lit("item"))
    found = {(r.centre_id, r.id) for r in vectors.points_within(points, points, 1.0, **tuning).collect()}
    gaps = np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(2))
    assert found == {(int(a), int(b)) for a, b in zip(*np.nonzero(np.round(gaps, 9) <= 1.0))}


def test_vectorless_items(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, None)], "item_id long, vector array<double>")
    rows = vectors.similar_by_cosine(items, 3, vectorless=True).orderBy("item_id", "rank").collect()
    assert [(r.item_id, r.other_id, r.score) for r in rows] == [
        (1, 2, 1.0), (1, 3, 0.0), (1, 4, 0.0), (2, 1, 1.0), (2, 3, 0.0), (2, 4, 0.0)]


@pytest.mark.parametrize("alpha", [0.0, 0.05, 0.6, 1.0])
def test_relocation_is_the_loop(spark, events, skewed, alpha):
    rng = np.random.default_rng(1)
    at = rng.normal(size=(150, 4))
    items = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(at)], "item_id long, vector array<double>")
    where = {}
    for u, i, s in sorted(skewed, key=lambda r: (r[2], r[1])):
        x = where.get(u, at.mean(0))
        where[u] = x + alpha * (at[i] - x)
    mine = {r.user_id: r.vector for r in space.relocated_users(events, items, alpha).collect()}
    assert mine.keys() == where.keys()
    for u, x in where.items():
        assert mine[u] == pytest.approx(list(x), abs=1e-9)


def test_rules_against_full_rows(spark, events):
    """Boosts and filters as if every item were scored, zeros included."""
    pairs = counts.distinct_pairs(events)
    s = cooc.item_similarity(cooc.cooccurrence(pairs, both_orders=True))
    tags = {i: ["a"] if i % 9 == 0 else ["b"] if i % 2 else ["c"] for i in range(160) if i % 13}
    metadata = spark.createDataFrame(list(tags.items()), "item_id long, filters array<string>")
    popular = counts.viewers_per_item(pairs).withColumnRenamed("viewers", "popularity")
    exclude = spark.createDataFrame([(0,), (18,), (27,)], "item_id long")
    keys = spark.range(155).withColumnRenamed("id", "item_id")
    k = 6
    rows = recommend.items_for_items(s, keys, k, popular, metadata=metadata, include=["a", "b"], enhance=["a"],
                                     bias=2.5, exclude=exclude).collect()
    score = {(r.item_id, r.other_id): r.similarity for r in s.collect()}
    most = [r.item_id for r in sorted(popular.collect(), key=lambda r: (-r.popularity, r.item_id))]
    mine = {}
    for r in sorted(rows, key=lambda r: (r.item_id, r["rank"])):
        mine.setdefault(r.item_id, []).append((r.other_id, r.similarity))
    banned = {0, 18, 27}
    for key in range(155):
        full = []
        for i, t in tags.items():
            if i == key or i in banned or not set(t) & {"a", "b"}:
                continue
            value = score.get((key, i), 0.0) + (2.5 if "a" in t else 0.0)
            if value:
                full.append((i, value))
        best = sorted(full, key=lambda e: (-e[1], e[0]))[:k]
        have = {i for i, _ in best} | banned | {key}
        best += [(i, None) for i in most if i not in have][:k - len(best)]
        assert mine[key] == best


@pytest.mark.parametrize("sizes", [(2, 3000), (3000, 2), (150, 200)])
def test_hot_keys_are_cut_on_either_side(spark, sizes):
    """A key hot on the right only, on the left only, or on both sides: no task makes it alone."""
    left = spark.range(sizes[0] + 5).selectExpr(f"if(id < {sizes[0]}, 1, id) AS k", "id AS a")
    right = spark.range(sizes[1] + 5).selectExpr(f"if(id < {sizes[1]}, 1, id) AS k", "id AS b")
    rows = fan_out_join(left, right, ["k"], ["a"], work_rows=500)
    assert sorted(map(tuple, rows.select("k", "a", "b").collect())) == sorted(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    shares = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(shares) < 0.6 * sum(shares)


def test_rows_without_a_time_come_last(spark):
    df = spark.createDataFrame([(1, None), (2, "2024-01-01 00:00:00"), (3, None)], "id int, t string").selectExpr("id", "CAST(t AS timestamp) AS t")
    for newest in (True, False):
        assert [r["id"] for r in first_rows(df, "t", 2, ["id"], newest).collect()] == [2, 1]
        assert [r["id"] for r in first_rows(df, "t", 1, ["id"], newest).collect()] == [2]


def test_vectors_of_unequal_length_are_named(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0, 4.0, 5.0])], "item_id bigint, vector array<double>")
    with pytest.raises(Exception, match="components"):
        from covista.operators.vectors import similar_by_distance
        similar_by_distance(df.coalesce(1), 1).collect()
