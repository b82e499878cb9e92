"""Hand-computed values on tiny data."""

import datetime

import pytest
from pyspark.sql import functions as F

from covista.functions import clean_year_title, genre_array, half_life_weight, has_any_term, similarity
from covista.operators import affinity as aff
from covista.operators import cooccurrence as cooc
from covista.operators import counts, recommend, space

BOB, HARRY, NARUTO, BATMAN, OFFICE, MAFIA, CRIME, SUSPENSE, TITANIC, STARS = range(10)
HISTORIES = {0: [BOB, NARUTO], 1: [MAFIA, CRIME], 2: [BOB, HARRY], 3: [TITANIC, STARS, OFFICE], 4: [BOB, OFFICE],
             5: [BOB, NARUTO]}


@pytest.fixture(scope="module")
def views(spark):
    day = datetime.datetime(2024, 1, 1)
    rows = [(u, i, day) for u, items in HISTORIES.items() for i in items]
    return spark.createDataFrame(rows, "user_id long, item_id long, event_time timestamp")


@pytest.fixture(scope="module")
def pairs(views):
    return counts.distinct_pairs(views)


def as_map(df, *keys):
    return {tuple(r[k] for k in keys): r[df.columns[-1]] for r in df.collect()}


def test_cooccurrence(pairs):
    c = as_map(cooc.cooccurrence(pairs), "item_id", "other_id")
    assert c[BOB, BOB] == 4 and c[BOB, NARUTO] == c[NARUTO, BOB] == 2 and c[NARUTO, NARUTO] == 2
    assert c[BOB, HARRY] == 1 and c[OFFICE, OFFICE] == 2
    assert c[OFFICE, TITANIC] == c[OFFICE, STARS] == c[OFFICE, BOB] == 1
    assert (TITANIC, BOB) not in c and not any(BATMAN in k or SUSPENSE in k for k in c)


def test_metrics(pairs):
    cells = cooc.cooccurrence(pairs)
    assert as_map(cooc.item_similarity(cells, "jaccard"), "item_id", "other_id")[BOB, NARUTO] == 0.5
    assert as_map(cooc.item_similarity(cells, "lift"), "item_id", "other_id")[BOB, NARUTO] == 0.25
    with pytest.raises(ValueError):
        similarity("cosine", F.lit(1), F.lit(1), F.lit(1))


def test_scores(views, pairs):
    a = aff.affinity(views, half_life=None)
    s = cooc.item_similarity(cooc.cooccurrence(pairs))
    y = as_map(aff.predicted_scores(a, s), "user_id", "item_id")
    assert (y[0, BOB], y[0, NARUTO], y[0, HARRY], y[0, OFFICE]) == (6, 4, 1, 1)
    asked = views.sparkSession.createDataFrame([(0, BOB), (0, TITANIC)], "user_id long, item_id long")
    assert as_map(aff.score_lookup(a, s, asked), "user_id", "item_id") == {(0, BOB): 6, (0, TITANIC): 0}
    unseen = as_map(aff.unseen_scored(aff.predicted_scores(a, s), pairs), "user_id", "item_id")
    assert unseen[0, HARRY] == 1 and (0, BOB) not in unseen


def test_score_popularity_without_scores(views, pairs):
    a = aff.affinity(views, half_life=None)
    s = cooc.item_similarity(cooc.cooccurrence(pairs))
    long = {k: v for k, v in as_map(
        aff.predicted_scores(a, s).groupBy("item_id").agg(F.sum("score").alias("p")), "item_id").items()}
    assert as_map(aff.score_popularity(a, s), "item_id") == long
    assert as_map(aff.count_score_popularity(a, pairs), "item_id") == long


def test_batches_add_up(spark, views):
    first, second = views.where("user_id < 3"), views.where("user_id >= 3")
    t0 = 1.7e9
    whole = as_map(aff.affinity(views.union(views), t0), "user_id", "item_id")
    parts = [as_map(aff.affinity(p, t0), "user_id", "item_id") for p in (first, first, second, second)]
    for key, value in whole.items():
        assert value == pytest.approx(sum(p.get(key, 0) for p in parts))


def test_half_life(spark):
    row = spark.range(1).select(*[
        half_life_weight(F.timestamp_seconds(F.lit(1000 - age)), 1000.0, 100).alias(str(age)) for age in (0, 100, 200)])
    assert tuple(row.first()) == (1.0, 0.5, 0.25)


def test_similar_items_fill_with_popular(views, pairs):
    s = cooc.item_similarity(cooc.cooccurrence(pairs))
    popular = aff.count_score_popularity(aff.affinity(views, half_life=None), pairs)
    items = pairs.select("item_id").distinct()
    lists = {}
    for r in recommend.items_for_items(s, items, 4, popular).orderBy("item_id", "rank").collect():
        lists.setdefault(r.item_id, []).append((r.other_id, r.source))
    assert all(len(v) == 4 and len({i for i, _ in v}) == 4 for v in lists.values())
    assert all(k not in {i for i, _ in v} for k, v in lists.items())
    assert [i for i, s in lists[NARUTO] if s == "scored"] == [BOB]
    assert [s for _, s in lists[MAFIA]] == ["scored", "popular", "popular", "popular"]


def test_ranking_and_cold_start(spark, views):
    ranking = as_map(counts.item_ranking(counts.views_per_item(views)), "item_id")
    assert ranking[(BOB,)] == 1 and ranking[(NARUTO,)] == ranking[(OFFICE,)] == 2 and ranking[(HARRY,)] == 3
    users = spark.createDataFrame([(0,), (77,)], "user_id long")
    assert [(r.user_id, r.rank, r.item_id) for r in counts.cold_start(users, views, 2).orderBy("rank").collect()] == [
        (77, 1, BOB), (77, 2, NARUTO)]
    assert counts.most_viewed(counts.views_per_item(views)).first().item_id == BOB


@pytest.mark.parametrize("raw, title, year", [
    ("Jumanji (1995)", "Jumanji", "1995"), ("No year", "No year", "1970"), ("A (1999) b (2001)", "A", "1999"),
    ("Y (20001)", "Y (20001)", "1970"), ("(1999) x", "", "1999"), (None, None, None)])
def test_titles(spark, raw, title, year):
    df = spark.createDataFrame([(raw,)], "t string").select(clean_year_title(F.col("t")).alias("c"))
    c = df.first().c
    assert (c.title, c.release_date) == (title, year) if raw is not None else c is None


def test_terms_and_genres(spark):
    df = spark.createDataFrame([("The Matrix Reloaded", "A|b"), ("Matrixes", "C")], "t string, g string")
    assert [r[0] for r in df.select(has_any_term(F.col("t"), "matrix", "awakens")).collect()] == [True, False]
    assert df.select(genre_array(F.col("g"))).first()[0] == ["a", "b"]


def test_space(spark):
    items = spark.createDataFrame([(101010, [1.0, 2.0, 3.0]), (202020, [1.0, 2.0, 4.0])], "item_id long, vector array<double>")
    day = datetime.datetime(2024, 1, 1)
    seen = spark.createDataFrame([(1, 101010, day), (2, 202020, day)], "user_id long, item_id long, event_time timestamp")
    everyone = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    users = space.relocated_users(seen, items, 0.6, everyone)
    at = {r.user_id: r.vector for r in users.collect()}
    assert at[1] == pytest.approx([1, 2, 3.2]) and at[2] == pytest.approx([1, 2, 3.8]) and at[3] == pytest.approx([1, 2, 3.5])
    near = {(r.user_id, r.rank): (r.item_id, r.distance) for r in space.nearest_items_to_users(users, items, 2).collect()}
    assert near[1, 1] == (101010, pytest.approx(0.2)) and near[1, 2] == (202020, pytest.approx(0.8))
    with pytest.raises(ValueError):
        space.nearest_items_to_users(users, items, 3)
