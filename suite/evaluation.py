"""Hold-out evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from covista.operators import affinity as aff
from covista.operators import cooccurrence as cooc
from covista.operators import evaluate as ops
from covista.operators import factors, space
from covista.operators.counts import distinct_pairs
from covista.operators.product import best_scores
from covista.operators.recommend import ranked
from covista.plans import stored
from suite.registry import query
from suite.tables import ALPHA, CELLS, HALF_LIFE, VECTORS, VIEWS, Tables, affinity_sql, with_sql
from suite.vectors import DIMS, MEAN, MOVED

SHARE = "CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0"
SIDES = (VIEWS.replace("views AS", "every AS"), f"held AS (SELECT * FROM every WHERE {SHARE} < 0.2)",
         f"views AS (SELECT * FROM every WHERE {SHARE} >= 0.2)", "pairs AS (SELECT DISTINCT user_id, item_id FROM views)")
TRAINED = (*SIDES, CELLS, affinity_sql(), """scores AS (
  SELECT a.user_id, c.other_id AS item_id, sum(a.a * c.n) AS score
  FROM affinity a JOIN cells c ON a.item_id = c.item_id GROUP BY 1, 2)""", """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM scores)""",
           "recs AS (SELECT user_id, item_id FROM numbered WHERE rank <= 20)")


def _sides(t: Tables):
    return ops.split_by_key(t.views, "event_id", 0.2)


def _trained(train):
    a = stored(aff.affinity(train, half_life=HALF_LIFE), "affinity")
    s = cooc.item_similarity(cooc.cooccurrence(stored(distinct_pairs(train), "train-pairs")))
    return a, stored(s, "similarity")


@query(with_sql(*SIDES) + """
SELECT 'train' AS side, count(*) AS n FROM views UNION ALL SELECT 'test', count(*) FROM held""")
def split_by_key(t: Tables):
    train, test = _sides(t)
    return (train.select(F.lit("train").alias("side")).unionAll(test.select(F.lit("test")))
            .groupBy("side").agg(F.count("*").alias("n")))


@query()
def random_split(t: Tables):
    train, test = ops.random_split(t.views, 0.2, seed=1)
    return train.withColumn("side", F.lit("train")).unionAll(test.withColumn("side", F.lit("test")))


@query(with_sql(VIEWS) + "SELECT count(*) AS views, 0::BIGINT AS twice, 0::BIGINT AS lost, true AS fair FROM views")
def random_split_check(t: Tables):
    """Both sides together are the table, no event is on both, and about a fifth is held out."""
    sides = random_split(t).groupBy("event_id").agg(F.count("*").alias("n"), F.count_if(F.col("side") == "test").alias("held"))
    whole = t.views.select("event_id").join(sides, "event_id", "left")
    share = F.sum("held") / F.count("*")
    return whole.agg(F.count("*").alias("views"), F.count_if(F.col("n") > 1).alias("twice"), F.count_if(F.col("n").isNull()).alias("lost"),
                     share.between(0.1, 0.3).alias("fair"))


@query(with_sql(*TRAINED) + """
SELECT DISTINCT h.user_id, h.item_id FROM held h JOIN recs r ON r.user_id = h.user_id AND r.item_id = h.item_id""")
def recommended_and_viewed(t: Tables):
    train, test = _sides(t)
    return ops.common_pairs(test, ranked(best_scores(*_trained(train), 20, test), "user_id", "item_id", 20))


@query(with_sql(*TRAINED, """tally AS (
  SELECT (SELECT count(*) FROM (SELECT user_id, item_id FROM held INTERSECT SELECT user_id, item_id FROM recs)) AS hits,
         (SELECT count(*) FROM held) AS test_rows,
         (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM held)) AS test_pairs)""") + """
SELECT hits, test_rows, test_pairs, round(hits / test_rows, 6) AS hit_ratio,
       round(hits / test_pairs, 6) AS distinct_hit_ratio FROM tally""")
def hit_ratio(t: Tables):
    train, test = _sides(t)
    row = ops.hit_ratio(test, ranked(best_scores(*_trained(train), 20, test), "user_id", "item_id", 20))
    return row.withColumn("hit_ratio", F.round("hit_ratio", 6)).withColumn(
        "distinct_hit_ratio", F.round("distinct_hit_ratio", 6))


@query(with_sql(*TRAINED, """stats AS (
  SELECT user_id, sum(score) / (SELECT count(DISTINCT item_id) FROM views) AS mean, max(score) AS top
  FROM scores GROUP BY 1)""", """judged AS (
  SELECT h.event_id, coalesce(s.score, 0) AS score, coalesce(u.mean, 0) AS mean, coalesce(u.top, 0) AS top,
         h.user_id IN (SELECT user_id FROM views) AND h.item_id IN (SELECT item_id FROM views) AS known
  FROM held h LEFT JOIN scores s ON s.user_id = h.user_id AND s.item_id = h.item_id
  LEFT JOIN stats u ON u.user_id = h.user_id)""") + """
SELECT round(coalesce(sum(CASE WHEN known AND round(score, 9) < round(mean, 9)
                               THEN pow(1 - score / top, 2) END), 0), 6) AS error,
       count(CASE WHEN known AND round(score, 9) < round(mean, 9) THEN 1 END) AS counted,
       count(CASE WHEN NOT known THEN 1 END) AS skipped
FROM judged""")
def squared_miss(t: Tables):
    train, test = _sides(t)
    n = train.agg(F.countDistinct("item_id").alias("n")).scalar()
    row = ops.squared_miss_of(test, *_trained(train), n, train.select("user_id"), train.select("item_id"))
    return row.withColumn("error", F.round("error", 6))


@query(with_sql(*SIDES, VECTORS, DIMS, MEAN, MOVED, """judged AS (
  SELECT CASE WHEN round(list_distance(p.vector, v.vector), 9) <= 0.9 THEN 1 ELSE 0 END AS predicted
  FROM held h JOIN people p ON p.user_id = h.user_id JOIN vecs v ON v.item_id = h.item_id)""") + """
SELECT count(*) AS tested, round(avg(1 - predicted), 6) AS error, round(avg(abs(1 - predicted)), 6) AS absolute_error
FROM judged""")
def prediction_error(t: Tables):
    train, test = _sides(t)
    people = space.relocated_users(train, t.vectors, ALPHA)
    row = space.prediction_error(test, people, t.vectors, 0.9)
    return row.withColumn("error", F.round("error", 6)).withColumn("absolute_error", F.round("absolute_error", 6))


@query(with_sql(*SIDES, VECTORS, DIMS, MEAN, MOVED) + """
SELECT h.user_id, h.item_id, round(list_distance(p.vector, v.vector), 6) AS distance,
       CASE WHEN round(list_distance(p.vector, v.vector), 9) <= 0.9 THEN 1 ELSE 0 END AS predicted
FROM held h JOIN people p ON p.user_id = h.user_id JOIN vecs v ON v.item_id = h.item_id""")
def radius_predictions(t: Tables):
    train, test = _sides(t)
    people = space.relocated_users(train, t.vectors, ALPHA)
    return space.predictions(test, people, t.vectors, 0.9).withColumn("distance", F.round("distance", 6))


COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 6) AS pearson FROM lineitem"
    for a in COLUMNS for b in COLUMNS))
def pearson_matrix(t: Tables):
    return ops.correlations(t.read("lineitem"), COLUMNS).withColumn("pearson", F.round("pearson", 6))


@query()
def tuning_grid(t: Tables):
    ties = ("user_id", "item_id", "l_orderkey", "l_linenumber")
    return ops.tuning_grid(t.purchases, ties=ties, together=8)


@query("""SELECT rank, max_iter, 0.01::DOUBLE AS reg_param, length, true AS timed
FROM (SELECT unnest([5, 20, 40, 100])::INTEGER AS rank), (SELECT unnest([3, 5, 10, 15])::INTEGER AS max_iter),
     (SELECT unnest([100, 1000, 5000, 10000, 25000, 50000])::BIGINT AS length)
WHERE (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) > 0""")
def tuning_grid_check(t: Tables):
    """Every setting of the grid is fitted once and timed."""
    return tuning_grid(t).select("rank", "max_iter", "reg_param", "length", (F.col("train_times") > 0).alias("timed"))


@query()
def als_hit_ratio(t: Tables):
    train, test = _sides(t)
    model = factors.train_implicit(train, rank=5, max_iter=3, seed=0)
    return ops.evaluate_model(model, train, test, 100)
