"""Vector scores, nearest items, radius queries, users in vector space."""

from __future__ import annotations

from pyspark.sql import functions as F

from covista.functions import (
    cosine_plus_one,
    distance_to_score,
    euclidean,
    has_genre,
    in_range,
    lacks_terms,
    logistic_dot,
    squared_distance,
)
from covista.operators import space, vectors
from covista.operators.factors import cluster_sizes, first_cluster_mates, two_hop
from covista.operators.recommend import ranked
from covista.plans import approximate_search, build_index, recall, search, stored
from suite.registry import query
from suite.tables import ALPHA, PURCHASES, VECTORS, VIEWS, Tables, with_sql

N = 10
RADIUS = 1.4
DIMS = "dims AS (SELECT item_id, generate_subscripts(vector, 1) AS pos, unnest(vector) AS v FROM vecs)"
MEAN = "mean_at AS (SELECT pos, avg(v) AS m FROM dims GROUP BY 1)"
CENTRE = "centre AS (SELECT list(m ORDER BY pos) AS c FROM mean_at)"
# closed form of the relocation, one row per user and component
MOVED = f"""steps AS (
  SELECT v.user_id, v.item_id,
         row_number() OVER (PARTITION BY v.user_id ORDER BY event_time DESC, v.item_id DESC) - 1 AS back,
         count(*) OVER (PARTITION BY v.user_id) AS n
  FROM views v JOIN vecs USING (item_id)),
moved_at AS (
  SELECT s.user_id, d.pos,
         pow({1 - ALPHA}::DOUBLE, max(n)) * max(m.m) + sum({ALPHA}::DOUBLE * pow({1 - ALPHA}::DOUBLE, back) * d.v) AS x
  FROM steps s JOIN dims d ON d.item_id = s.item_id JOIN mean_at m ON m.pos = d.pos GROUP BY 1, 2),
people AS (SELECT user_id, list(x ORDER BY pos) AS vector FROM moved_at GROUP BY 1)"""
USERS = (VIEWS, VECTORS, DIMS, MEAN, MOVED)


def _users(t: Tables):
    return stored(space.relocated_users(t.views, t.vectors, ALPHA), "people")


def _long_rank(df):
    return df.withColumn("rank", F.col("rank").cast("long"))


def _components(df, key=None):
    columns = ([key] if key else []) + [F.posexplode("vector").alias("pos", "value")]
    return df.select(*columns).withColumn("pos", (F.col("pos") + 1).cast("long")).withColumn("value", F.round("value", 6))


@query(with_sql(VECTORS, DIMS, MEAN, CENTRE) + """
SELECT item_id, round(pow(list_distance(vector, c), 2), 6) AS squared, round(list_distance(vector, c), 6) AS distance,
       round(1 / (1 + exp(-list_inner_product(vector, c))), 6) AS logistic,
       round(list_cosine_similarity(vector, c) + 1, 6) AS cosine, round(1 - pow(list_distance(vector, c), 2), 6) AS score
FROM vecs CROSS JOIN centre""")
def vector_scores(t: Tables):
    """Every vector against the mean vector."""
    v, c = F.col("vector"), space.mean_vector(t.vectors).scalar()
    return t.vectors.withColumn("c", c).select(
        "item_id", F.round(squared_distance(v, F.col("c")), 6).alias("squared"),
        F.round(euclidean(v, F.col("c")), 6).alias("distance"), F.round(logistic_dot(v, F.col("c")), 6).alias("logistic"),
        F.round(cosine_plus_one(v, F.col("c")), 6).alias("cosine"),
        F.round(distance_to_score(squared_distance(v, F.col("c"))), 6).alias("score"))


@query(with_sql(VECTORS) + """
SELECT p_partkey AS item_id, CASE WHEN vector IS NULL THEN 0.0 ELSE
       round(list_cosine_similarity(vector, (SELECT vector FROM vecs WHERE item_id = 0)) + 1, 6) END AS cosine,
       CASE WHEN vector IS NULL THEN 0.0 ELSE
       round(1 / (1 + exp(-list_inner_product(vector, (SELECT vector FROM vecs WHERE item_id = 0)))), 6) END AS logistic
FROM part LEFT JOIN vecs ON item_id = p_partkey""")
def scores_with_missing_vectors(t: Tables):
    """Catalogue items, many of them without a vector, against one item's vector."""
    seed = t.vectors.where(F.col("item_id") == 0).select("vector").scalar()
    parts = t.read("part").select(F.col("p_partkey").alias("item_id")).join(t.vectors, "item_id", "left")
    rows = parts.withColumn("seed", seed)
    return rows.select("item_id", F.round(cosine_plus_one(F.col("vector"), F.col("seed")), 6).alias("cosine"),
                       F.round(logistic_dot(F.col("vector"), F.col("seed")), 6).alias("logistic"))


@query(with_sql(VECTORS, DIMS, MEAN) + "SELECT pos, round(m, 6) AS value FROM mean_at")
def mean_vector(t: Tables):
    return _components(space.mean_vector(t.vectors))


@query(with_sql(VIEWS, VECTORS, DIMS, "pairs AS (SELECT DISTINCT user_id, item_id FROM views)") + """
SELECT user_id, pos, round(avg(v), 6) AS value FROM pairs JOIN dims USING (item_id) GROUP BY 1, 2""")
def user_mean_vectors(t: Tables):
    return _components(space.user_means(t.view_pairs, t.vectors), "user_id")


@query(with_sql(VIEWS, VECTORS, DIMS, MEAN) + """
SELECT user_id, pos, round(m, 6) AS value FROM (SELECT DISTINCT user_id FROM views) CROSS JOIN mean_at""")
def placed_users(t: Tables):
    return _components(space.placed_users(t.views, t.vectors), "user_id")


@query(with_sql(*USERS) + "SELECT user_id, pos, round(x, 6) AS value FROM moved_at")
def relocated_users(t: Tables):
    return _components(_users(t), "user_id")


@query(with_sql(*USERS) + "SELECT user_id, pos, round(x, 6) AS value FROM moved_at")
def relocated_by_slices(t: Tables):
    """Kept states of three slices of time, composed in order, equal the relocation by all events."""
    views = t.views
    ends = views.agg(F.percentile_approx(F.col("event_time").cast("double"), [0.4, 0.8]).alias("p")).first()["p"]
    time = F.col("event_time").cast("double")
    spans = (time < ends[0], (time >= ends[0]) & (time < ends[1]), time >= ends[1])
    first, second, third = (stored(space.relocation_state(views.where(s), t.vectors, ALPHA), "moves") for s in spans)
    state = space.composed(first, stored(space.composed(second, third, ALPHA), "later-moves"), ALPHA)
    return _components(space.placed_by(state, t.vectors, ALPHA), "user_id")


@query(with_sql(VIEWS, VECTORS, DIMS, MEAN, "pairs AS (SELECT DISTINCT user_id, item_id FROM views)") + f"""
SELECT user_id, d.pos, round(max(m) + {ALPHA}::DOUBLE * (avg(v) - max(m)), 6) AS value
FROM pairs JOIN dims d USING (item_id) JOIN mean_at m ON m.pos = d.pos GROUP BY 1, 2""")
def relocated_in_batch(t: Tables):
    return _components(space.relocated_in_batch(t.view_pairs, t.vectors, ALPHA), "user_id")


@query(with_sql(*USERS) + """
SELECT user_id AS id, 'user' AS type, round(list_sum(vector), 6) AS total FROM people
UNION ALL SELECT item_id, 'item', round(list_sum(vector), 6) FROM vecs""")
def all_points(t: Tables):
    total = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v)
    return space.points(_users(t), t.vectors).select("id", "type", F.round(total, 6).alias("total"))


def _nearest_sql(seeds: str, pool: str, cost: str, value: str, key: str, other: str, own: bool, n: int = N) -> str:
    guard = "WHERE s.id <> i.id" if own else ""
    return f"""
SELECT id AS {key}, rank, cand AS {other}, {value}
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(cost, 9), cand) AS rank FROM (
  SELECT s.id, i.id AS cand, {cost} AS cost FROM ({seeds}) s CROSS JOIN ({pool}) i {guard})) WHERE rank <= {n}"""


ITEMS = "SELECT item_id AS id, vector FROM vecs"
PEOPLE = "SELECT user_id AS id, vector FROM people"


@query(with_sql(VECTORS) + _nearest_sql(
    ITEMS, ITEMS, "list_distance(s.vector, i.vector)",
    "round(cost, 6) AS distance, round(cost * cost, 6) AS difference, round(1 - cost * cost, 6) AS score",
    "item_id", "other_id", True))
def similar_by_distance(t: Tables):
    hits = vectors.similar_by_distance(t.vectors, N)
    return _long_rank(hits).select("item_id", "rank", "other_id", F.round("distance", 6).alias("distance"),
                                   F.round("difference", 6).alias("difference"),
                                   F.round(distance_to_score(F.col("difference")), 6).alias("score"))


@query(with_sql(VECTORS) + _nearest_sql(
    ITEMS, ITEMS, "-list_cosine_similarity(s.vector, i.vector)", "round(1 - cost, 6) AS score", "item_id", "other_id", True))
def similar_by_cosine(t: Tables):
    return _long_rank(vectors.similar_by_cosine(t.vectors, N)).withColumn("score", F.round("score", 6))


def _approximate(t: Tables, metric: str):
    """Recall against the exact search over all rows, and exact costs of what both found."""
    seeds = t.vectors.withColumnRenamed("item_id", "seed_id")
    found = stored(approximate_search(seeds, build_index(t.vectors, metric), N, exclude_self=True), "approximate")
    exact = stored(search(seeds, t.vectors, N, metric=metric, exclude_self=True), "exact")
    both = found.join(exact.select("seed_id", "item_id", F.col("cost").alias("own")), ["seed_id", "item_id"])
    wrong = both.where(F.abs(F.col("cost") - F.col("own")) > 1e-6).agg(F.count("*").alias("n")).scalar()
    return found.agg(F.countDistinct("seed_id").alias("seeds"), F.count("*").alias("found"), F.max("rank").alias("longest"),
                     wrong.alias("wrong_costs"),
                     (recall(found, exact).scalar() >= 0.9).alias("recalled"))


APPROXIMATE_SQL = with_sql(VECTORS) + f"""
SELECT count(*) AS seeds, CAST(count(*) * {N} AS BIGINT) AS found, CAST({N} AS INTEGER) AS longest,
       CAST(0 AS BIGINT) AS wrong_costs, true AS recalled FROM vecs"""


@query(APPROXIMATE_SQL)
def approximate_by_distance(t: Tables):
    return _approximate(t, "euclidean")


@query(APPROXIMATE_SQL)
def approximate_by_cosine(t: Tables):
    return _approximate(t, "cosine")


DESCRIBED = """described AS (
  SELECT item_id AS id, vector, p_name, p_type, 1950 + p_size AS year FROM vecs LEFT JOIN part ON p_partkey = item_id)"""


@query(with_sql(VECTORS, DESCRIBED) + _nearest_sql(
    "SELECT id, vector FROM described", """SELECT id, vector FROM described
    WHERE NOT list_contains(string_split_regex(lower(p_name), '[^a-z]+'), 'ring')""",
    "-list_cosine_similarity(s.vector, i.vector)", "round(1 - cost, 6) AS score", "item_id", "other_id", True))
def similar_without_term(t: Tables):
    hits = vectors.similar_by_cosine(t.described_vectors, N, where=lacks_terms(F.col("title"), "ring"))
    return _long_rank(hits).withColumn("score", F.round("score", 6))


@query(with_sql(VECTORS, DESCRIBED) + _nearest_sql(
    "SELECT id, vector FROM described", "SELECT id, vector FROM described WHERE p_type = 'PROMO'",
    "-list_cosine_similarity(s.vector, i.vector)", "round(1 - cost, 6) AS score", "item_id", "other_id", True))
def similar_of_genre(t: Tables):
    hits = vectors.similar_by_cosine(t.described_vectors, N, where=has_genre(F.col("genres"), "promo"))
    return _long_rank(hits).withColumn("score", F.round("score", 6))


LOGISTIC = "round(1 / (1 + exp(cost)), 6) AS score"


@query(with_sql(*USERS) + _nearest_sql(
    PEOPLE, ITEMS, "-list_inner_product(s.vector, i.vector)", LOGISTIC, "user_id", "item_id", False))
def items_by_product(t: Tables):
    return _long_rank(vectors.items_by_product(_users(t), t.vectors, N)).withColumn("score", F.round("score", 6))


@query(with_sql(*USERS, DESCRIBED) + _nearest_sql(
    PEOPLE, "SELECT id, vector FROM described WHERE year >= 1985",
    "-list_inner_product(s.vector, i.vector)", LOGISTIC, "user_id", "item_id", False))
def recent_items_by_product(t: Tables):
    hits = vectors.items_by_product(_users(t), t.described_vectors, N, where=in_range(F.col("year"), 1985))
    return _long_rank(hits).withColumn("score", F.round("score", 6))


@query(with_sql(*USERS) + _nearest_sql(
    PEOPLE, ITEMS, "list_distance(s.vector, i.vector)", "round(cost, 6) AS distance", "user_id", "item_id", False))
def nearest_items_to_users(t: Tables):
    hits = space.nearest_items_to_users(_users(t), t.vectors, N)
    return _long_rank(hits).withColumn("distance", F.round("distance", 6))


@query(with_sql(VECTORS) + _nearest_sql(
    ITEMS, ITEMS, "list_distance(s.vector, i.vector)", "round(cost, 6) AS distance", "item_id", "other_id", True, 5))
def nearest_items_to_items(t: Tables):
    return _long_rank(space.nearest_items_to_items(t.vectors, 5)).withColumn("distance", F.round("distance", 6))


WITHIN = f"""
SELECT p.user_id AS centre_id, i.item_id AS id, round(list_distance(p.vector, i.vector), 6) AS distance
FROM people p CROSS JOIN vecs i WHERE round(list_distance(p.vector, i.vector), 9) <= {RADIUS / 2}"""


@query(with_sql(*USERS) + WITHIN)
def items_within_radius(t: Tables):
    people = _users(t)
    centres = people.select(F.col("user_id").alias("id"), "vector")
    hits = vectors.points_within(centres, space.points(people, t.vectors), RADIUS / 2)
    return hits.withColumn("distance", F.round("distance", 6))


@query(with_sql(*USERS, f"inside AS ({WITHIN})", """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY centre_id ORDER BY distance, id) AS rn FROM inside)""") + """
SELECT centre_id, id, distance FROM numbered WHERE rn <= 3""")
def nearest_within_radius(t: Tables):
    people = _users(t)
    centres = people.select(F.col("user_id").alias("id"), "vector")
    hits = vectors.points_within(centres, space.points(people, t.vectors), RADIUS / 2, truncate=3)
    return hits.withColumn("distance", F.round("distance", 6))


@query(with_sql(*USERS, PURCHASES, """summed AS (
  SELECT user_id, item_id, sum(rating) AS rating FROM purchases GROUP BY 1, 2)""", """rated AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM summed)""",
                "recs AS (" + _nearest_sql(PEOPLE, ITEMS, "-list_inner_product(s.vector, i.vector)", LOGISTIC,
                                           "user_id", "item_id", False, 5) + ")") + """
SELECT user_id, 'rated' AS part, rank, item_id, p_name AS title, rating AS score
FROM rated LEFT JOIN part ON p_partkey = item_id WHERE rank <= 5 AND user_id IN (SELECT user_id FROM people)
UNION ALL
SELECT user_id, 'recommended', rank, item_id, p_name, score FROM recs LEFT JOIN part ON p_partkey = item_id""")
def recommendation_report(t: Tables):
    people = _users(t)
    movies = t.read("part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    rated = (t.purchases.join(people.select("user_id"), "user_id", "left_semi")
             .groupBy("user_id", "item_id").agg(F.sum("rating").alias("rating")))
    best = vectors.rated_titles(rated, movies, 5)
    recs = vectors.items_by_product(people, t.vectors, 5).withColumn("score", F.round("score", 6))
    return _long_rank(vectors.recommendation_report(best, recs, movies))


@query(with_sql(VECTORS, "sizes AS (SELECT label AS cluster, count(*) AS items FROM embeddings GROUP BY 1)") + "SELECT * FROM sizes")
def label_sizes(t: Tables):
    return cluster_sizes(t.read("embeddings").select(F.col("vec_id").alias("item_id"), F.col("label").alias("cluster")))


@query("""WITH pairs AS (
  SELECT a.vec_id AS item_id, b.vec_id AS other_id,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)
SELECT item_id, rank, other_id FROM pairs WHERE rank <= 10""")
def label_mates(t: Tables):
    rows = t.read("embeddings").select(F.col("vec_id").alias("item_id"), F.col("label").alias("cluster"))
    return _long_rank(first_cluster_mates(rows, N))


@query(with_sql(PURCHASES, "summed AS (SELECT user_id, item_id, sum(rating) AS rating FROM purchases GROUP BY 1, 2)", """u AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rating DESC, user_id) AS rank FROM summed)""", """i AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM summed)""") + """
SELECT u.item_id, i.item_id AS other_id, round(sum(u.rating * i.rating), 6) AS score
FROM u JOIN i ON u.user_id = i.user_id WHERE u.rank <= 10 AND i.rank <= 20 GROUP BY 1, 2""")
def two_hop_items(t: Tables):
    """Two hops over stored lists: best users of an item, then their best items."""
    rated = stored(t.purchases.groupBy("user_id", "item_id").agg(F.sum("rating").alias("rating")), "rated")
    users = stored(ranked(rated, "item_id", "user_id", 10, "rating"), "users")
    items = stored(ranked(rated, "user_id", "item_id", 20, "rating"), "items")
    return two_hop(users, items).withColumn("score", F.round("score", 6))
