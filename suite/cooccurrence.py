"""Co-occurrence, similarity, affinity and predicted scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from covista.functions import half_life_weight
from covista.operators import affinity as aff
from covista.operators import cooccurrence as ops
from covista.operators import counts, product
from covista.operators.recommend import ranked
from covista.plans import stored
from suite.registry import query
from suite.tables import (
    CELLS,
    HALF_LIFE,
    INDEX_START,
    OWN,
    PURCHASE_PAIRS,
    PURCHASES,
    SCORES,
    VIEW_PAIRS,
    VIEWS,
    Tables,
    affinity_sql,
    with_sql,
)

PURCHASE_CELLS = (PURCHASES, PURCHASE_PAIRS, CELLS)
VIEW_CELLS = (VIEWS, VIEW_PAIRS, CELLS)


@query(with_sql(*PURCHASE_CELLS) + "SELECT item_id, other_id, n AS both FROM cells WHERE item_id <= other_id")
def cooccurrence(t: Tables):
    """The upper half with the diagonal; the matrix is symmetric."""
    return ops.cooccurrence(t.purchase_pairs, both_orders=False)


@query(with_sql(*VIEW_CELLS) + "SELECT item_id, other_id, n AS both FROM cells")
def cooccurrence_of_views(t: Tables):
    return ops.cooccurrence(t.view_pairs)


def _metric_sql(expression: str) -> str:
    return with_sql(*PURCHASE_CELLS, OWN, f"""measured AS (
  SELECT c.item_id, c.other_id, {expression} AS similarity
  FROM cells c JOIN own a ON a.item_id = c.item_id JOIN own b ON b.item_id = c.other_id
  WHERE c.item_id <> c.other_id)""", """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(similarity, 9) DESC, other_id) AS rank
  FROM measured)""") + """
SELECT item_id, rank, other_id, round(similarity, 9) AS similarity FROM numbered WHERE rank <= 10"""


def _most_similar(t: Tables, metric: str):
    half = ops.half_cells(t.purchase_pairs, with_viewers=True)
    s = ops.mirrored(ops.item_similarity(half, metric))
    return ranked(s, "item_id", "other_id", 10, "similarity").select(
        "item_id", F.col("rank").cast("long").alias("rank"), "other_id", F.round("similarity", 9).alias("similarity"))


@query(_metric_sql("CAST(n AS DOUBLE) / (a.viewers + b.viewers - n)"))
def jaccard_similarity(t: Tables):
    return _most_similar(t, "jaccard")


@query(_metric_sql("CAST(n AS DOUBLE) / (a.viewers * b.viewers)"))
def lift_similarity(t: Tables):
    return _most_similar(t, "lift")


@query(with_sql(*VIEW_CELLS, """top AS (
  SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS place FROM views GROUP BY 1)""") + """
SELECT item_id, """ + ", ".join(
    f"CAST(sum(CASE WHEN other_id = (SELECT item_id FROM top WHERE place = {p}) THEN n ELSE 0 END) AS BIGINT) AS top_{p}"
    for p in range(1, 6)) + """
FROM cells GROUP BY 1
HAVING sum(CASE WHEN other_id IN (SELECT item_id FROM top WHERE place <= 5) THEN n ELSE 0 END) > 0""")
def cooccurrence_table(t: Tables):
    """One column for each of the five most viewed items."""
    views = t.views
    best = [r["item_id"] for r in counts.popular(views, 5).collect()]
    wide = ops.cooccurrence_table(ops.cooccurrence(t.view_pairs), best)
    return wide.select("item_id", *[F.col(f"`{b}`").alias(f"top_{i + 1}") for i, b in enumerate(best)])


@query(with_sql(PURCHASES, PURCHASE_PAIRS) + """
SELECT a.item_id, count(*) AS pairs FROM pairs a JOIN pairs b ON a.user_id = b.user_id GROUP BY 1""")
def history_self_join(t: Tables):
    return ops.pairs_per_item(t.purchase_pairs)


@query(with_sql(*PURCHASE_CELLS) + """
SELECT item_id, CAST(sum(n) AS BIGINT) AS pairs FROM cells GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def most_connected_item(t: Tables):
    return ops.most_connected(t.purchase_pairs)


@query(with_sql(*PURCHASE_CELLS) + """
SELECT item_id, other_id, n AS both FROM cells WHERE item_id < other_id ORDER BY 3 DESC, 1, 2 LIMIT 50""")
def strongest_pairs(t: Tables):
    cells = ops.cooccurrence(t.purchase_pairs, both_orders=False, diagonal=False)
    return cells.orderBy(F.desc("both"), "item_id", "other_id").limit(50)


@query(with_sql(*VIEW_CELLS, OWN, """best AS (
  SELECT item_id, other_id, n, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, other_id) AS rn
  FROM cells WHERE item_id <> other_id)""") + """
SELECT x.item_id, x.other_id, a.viewers AS viewers_a, b.viewers AS viewers_b, x.n AS viewers_both
FROM best x JOIN own a ON a.item_id = x.item_id JOIN own b ON b.item_id = x.other_id WHERE rn = 1""")
def pair_audit(t: Tables):
    """Every item with the item it is most often viewed with."""
    pairs = t.view_pairs
    cells = ops.cooccurrence(pairs, diagonal=False)
    return ops.pair_audit(pairs, ranked(cells, "item_id", "other_id", 1, score="both"))


@query(with_sql(*PURCHASE_CELLS) + """
SELECT count(*) AS cells, 0::BIGINT AS mismatches, 0::BIGINT AS asymmetric, 0::BIGINT AS wrong_diagonal FROM cells""")
def cooccurrence_check(t: Tables):
    pairs = t.purchase_pairs
    return ops.consistency_check(pairs, stored(ops.cooccurrence(pairs), "cells"))


@query(with_sql(VIEWS) + f"""
SELECT event_id, round(pow(2.0, -((SELECT epoch(max(event_time)) FROM views) - epoch(event_time)) / {HALF_LIFE}), 6) AS weight
FROM views""")
def event_weights(t: Tables):
    views = t.views
    newest = views.agg(F.max("event_time").cast("double").alias("t")).scalar()
    return views.select("event_id", F.round(half_life_weight(F.col("event_time"), newest, HALF_LIFE), 6).alias("weight"))


@query(with_sql(PURCHASES, affinity_sql("purchases", 17 / 3 * 10**8)) + """
SELECT user_id, item_id, round(a, 6) AS affinity FROM affinity""")
def user_affinity(t: Tables):
    return aff.affinity(t.purchases).withColumn("affinity", F.round("affinity", 6))


@query(with_sql(PURCHASES, affinity_sql("purchases", 17 / 3 * 10**8)) + """
SELECT user_id, item_id, round(a, 6) AS affinity FROM affinity""")
def affinity_of_slices(t: Tables):
    """States of three slices of time, merged out of order, give the affinity of all events."""
    early, middle, late = (aff.affinity_state(t.purchases.where(span)) for span in (
        F.col("event_time") < INDEX_START, F.year("event_time") == 1997, F.col("event_time") >= "1998-01-01"))
    kept = stored(aff.merged_states(stored(late, "late-state"), stored(early, "early-state")), "state")
    return aff.affinity_of(aff.merged_states(kept, stored(middle, "middle-state"))).withColumn("affinity", F.round("affinity", 6))


@query(with_sql(*VIEW_CELLS) + "SELECT item_id, other_id, n AS both FROM cells")
def extended_cooccurrence(t: Tables):
    """A fit on the first events, extended twice by later ones, equals the fit on all."""
    day = F.pmod(F.datediff("event_time", F.lit(INDEX_START)), F.lit(3))
    views = t.views.withColumn("slice", day)
    pairs = stored(counts.distinct_pairs(views.where(F.col("slice") == 0)), "first-pairs")
    cells = stored(ops.cooccurrence(pairs), "first-cells")
    for k in (1, 2):
        cells, pairs = ops.extended_cooccurrence(cells, pairs, views.where(F.col("slice") == k))
        cells, pairs = stored(cells, "cells"), stored(pairs, "pairs")
    return cells


@query(with_sql(PURCHASES) + """
SELECT user_id, item_id, CAST(count(*) AS DOUBLE) AS affinity FROM purchases GROUP BY 1, 2""")
def plain_affinity(t: Tables):
    return aff.affinity(t.purchases, half_life=None)


def _affinity(t: Tables):
    return stored(aff.affinity(t.views, half_life=HALF_LIFE), "affinity")


def _similarity(t: Tables, metric: str = "counts"):
    pairs = t.view_pairs
    return ops.item_similarity(ops.cooccurrence(pairs), metric, counts.viewers_per_item(pairs))


SCORED = (VIEWS, VIEW_PAIRS, CELLS, affinity_sql(), SCORES)


@query(with_sql(*SCORED) + "SELECT user_id, item_id, round(score, 6) AS score FROM scores")
def predicted_scores(t: Tables):
    return aff.predicted_scores(_affinity(t), _similarity(t)).withColumn("score", F.round("score", 6))


@query(with_sql(*SCORED) + """
SELECT p.user_id, p.item_id, round(coalesce(score, 0.0), 6) AS score
FROM pairs p LEFT JOIN scores s ON s.user_id = p.user_id AND s.item_id = p.item_id""")
def score_lookup(t: Tables):
    return aff.score_lookup(_affinity(t), _similarity(t), t.view_pairs).withColumn("score", F.round("score", 6))


@query(with_sql(*SCORED) + """
SELECT p_partkey AS item_id, round(coalesce(sum(score), 0.0), 6) AS popularity
FROM part LEFT JOIN scores ON item_id = p_partkey GROUP BY 1""")
def score_popularity(t: Tables):
    items = t.read("part").select(F.col("p_partkey").alias("item_id"))
    return aff.count_score_popularity(_affinity(t), t.view_pairs, items).withColumn("popularity", F.round("popularity", 6))


@query(with_sql(VIEWS, VIEW_PAIRS, CELLS, OWN, affinity_sql()) + """
SELECT c.other_id AS item_id, round(sum(a.a * c.n / (x.viewers + y.viewers - c.n)), 6) AS popularity
FROM affinity a JOIN cells c ON a.item_id = c.item_id
JOIN own x ON x.item_id = c.item_id JOIN own y ON y.item_id = c.other_id GROUP BY 1""")
def jaccard_popularity(t: Tables):
    return aff.score_popularity(_affinity(t), _similarity(t, "jaccard")).withColumn("popularity", F.round("popularity", 6))


@query(with_sql(*SCORED) + """
SELECT item_id, round(sum(score), 6) AS popularity FROM scores WHERE item_id NOT IN (
  SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')
GROUP BY 1 ORDER BY round(sum(score), 9) DESC, item_id LIMIT 10""")
def popular_by_score(t: Tables):
    banned = t.read("part").where(F.col("p_type") == "ECONOMY").select(F.col("p_partkey").alias("item_id"))
    totals = aff.count_score_popularity(_affinity(t), t.view_pairs)
    return aff.popular_by_score(totals, 10, banned).withColumn("popularity", F.round("popularity", 6))


@query(with_sql(*SCORED) + """
SELECT user_id, round(sum(score) / (SELECT count(DISTINCT item_id) FROM views), 6) AS mean_score,
       round(greatest(max(score), 0.0), 6) AS max_score
FROM scores GROUP BY 1""")
def user_score_stats(t: Tables):
    items = t.views.agg(F.countDistinct("item_id").alias("n")).scalar()
    return product.score_stats(_affinity(t), _similarity(t), items).select(
        "user_id", F.round("mean_score", 6).alias("mean_score"), F.round("max_score", 6).alias("max_score"))


@query(with_sql(*SCORED) + """
SELECT s.user_id, s.item_id, round(score, 6) AS score FROM scores s
WHERE score <> 0 AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.user_id = s.user_id AND p.item_id = s.item_id)""")
def unseen_but_scored(t: Tables):
    scores = aff.predicted_scores(_affinity(t), _similarity(t))
    return aff.unseen_scored(scores, t.view_pairs).withColumn("score", F.round("score", 6))
