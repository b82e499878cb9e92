"""Counts, lists, rankings, popular items."""

from __future__ import annotations

from pyspark.sql import functions as F

from covista.functions import confidence, list_position, preference
from covista.operators import counts as ops
from suite.registry import query
from suite.tables import PURCHASE_PAIRS, PURCHASES, VIEWS, Tables, with_sql

BATCH = 5000
TIES = ("user_id", "item_id", "l_orderkey", "l_linenumber")
NEWEST = f"""batch AS (
  SELECT * FROM purchases ORDER BY event_time DESC, user_id, item_id, l_orderkey, l_linenumber LIMIT {BATCH})"""


@query(with_sql(PURCHASES) + "SELECT item_id, count(*) AS views FROM purchases GROUP BY 1")
def item_views(t: Tables):
    return ops.views_per_item(t.purchases)


@query(with_sql(PURCHASES, PURCHASE_PAIRS) + """
SELECT item_id, 0 AS part, array_to_string(list(user_id ORDER BY user_id), ',') AS viewers FROM pairs GROUP BY 1""")
def viewer_lists(t: Tables):
    path = t.scratch("viewers")
    ops.viewer_sets(t.purchase_pairs).write.json(path)
    stored = t.spark.read.schema("item_id long, part int, viewers array<long>").json(path)
    return stored.withColumn("viewers", F.array_join("viewers", ","))


@query(with_sql(PURCHASES, PURCHASE_PAIRS) + """
SELECT user_id, 0 AS part, array_to_string(list(item_id ORDER BY item_id), ',') AS items FROM pairs GROUP BY 1""")
def user_histories(t: Tables):
    return ops.histories(t.purchase_pairs).withColumn("items", F.array_join("items", ","))


@query(with_sql(PURCHASES, PURCHASE_PAIRS) + "SELECT user_id, item_id FROM pairs")
def history_events(t: Tables):
    return ops.history_rows(ops.histories(t.purchase_pairs))


@query(with_sql(PURCHASES, PURCHASE_PAIRS) + "SELECT count(*) AS pairs FROM pairs")
def interactions_used(t: Tables):
    return ops.interactions_used(ops.distinct_pairs(t.purchases))


@query(with_sql(VIEWS) + "SELECT DISTINCT user_id FROM views")
def viewers_of_any(t: Tables):
    return ops.viewers_of_any(t.views)


@query(with_sql(PURCHASES, PURCHASE_PAIRS) + """
SELECT p_partkey AS item_id, (SELECT count(DISTINCT user_id) FROM pairs) - count(user_id) AS non_viewers
FROM part LEFT JOIN pairs ON item_id = p_partkey GROUP BY 1""")
def non_viewers(t: Tables):
    return ops.non_viewers(t.purchase_pairs, t.read("part").select(F.col("p_partkey").alias("item_id")))


@query(with_sql(VIEWS) + """
SELECT DISTINCT user_id FROM views WHERE user_id NOT IN (SELECT user_id FROM views WHERE item_id = 7)""")
def users_without_item(t: Tables):
    return ops.users_without(t.views, 7)


@query(with_sql(PURCHASES, "c AS (SELECT item_id, count(*) AS views FROM purchases GROUP BY 1)") + """
SELECT item_id, views, dense_rank() OVER (ORDER BY views DESC) AS ranking FROM c""")
def item_ranking(t: Tables):
    return ops.item_ranking(ops.views_per_item(t.purchases)).withColumn("ranking", F.col("ranking").cast("long"))


@query(with_sql(PURCHASES, "c AS (SELECT item_id, count(*) AS views FROM purchases GROUP BY 1)") + """
SELECT item_id, views, dense_rank() OVER (ORDER BY views) AS position FROM c""")
def ranking_by_position(t: Tables):
    """Rank as the place of the count among the distinct counts, lowest first."""
    ranked = ops.item_ranking(ops.views_per_item(t.purchases), ascending=True)
    return ranked.select("item_id", "views", F.col("ranking").cast("long").alias("position"))


@query("""SELECT l_returnflag, CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 WHEN 'A' THEN 3 END::BIGINT AS position, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def flag_positions(t: Tables):
    """Place in a short list of constants."""
    order = F.array(F.lit("N"), F.lit("R"), F.lit("A"))
    return (t.read("lineitem").withColumn("position", list_position(order, F.col("l_returnflag")).cast("long"))
            .groupBy("l_returnflag", "position").agg(F.count("*").alias("n")))


@query(with_sql(PURCHASES, NEWEST, "c AS (SELECT item_id, count(*) AS views FROM batch GROUP BY 1)") + """
SELECT item_id, views, dense_rank() OVER (ORDER BY views DESC) AS ranking FROM c""")
def updated_ranking(t: Tables):
    return ops.update_ranking(t.purchases, BATCH, TIES).withColumn("ranking", F.col("ranking").cast("long"))


@query(with_sql(PURCHASES, NEWEST, "c AS (SELECT item_id, count(*) AS views FROM batch GROUP BY 1)", """r AS (
  SELECT item_id, views, dense_rank() OVER (ORDER BY views DESC) AS ranking FROM c)""") + """
SELECT item_id, views, ranking FROM r ORDER BY ranking, item_id LIMIT 20""")
def ranked_popular(t: Tables):
    path = t.scratch("ranking")
    ops.update_ranking(t.purchases, BATCH, TIES).write.parquet(path)
    return ops.ranked_popular(t.spark.read.parquet(path), 20).withColumn("ranking", F.col("ranking").cast("long"))


@query(with_sql(PURCHASES) + """
SELECT item_id, count(*) AS views FROM purchases GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def popular_items(t: Tables):
    return ops.popular(t.purchases, 20)


@query(with_sql(PURCHASES, NEWEST) + """
SELECT item_id, count(*) AS views FROM batch GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def popular_in_batch(t: Tables):
    return ops.popular(t.purchases, 20, BATCH, TIES)


@query(with_sql(VIEWS, """best AS (
  SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS rank FROM views GROUP BY 1)""") + """
SELECT c_custkey AS user_id, rank, item_id FROM customer CROSS JOIN best
WHERE rank <= 10 AND c_custkey NOT IN (SELECT user_id FROM views)""")
def cold_start(t: Tables):
    users = t.read("customer").select(F.col("c_custkey").alias("user_id"))
    return ops.cold_start(users, t.views, 10).withColumn("rank", F.col("rank").cast("long"))


@query(with_sql(PURCHASES) + """
SELECT item_id, count(*) AS views FROM purchases GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def most_viewed_item(t: Tables):
    return ops.most_viewed(ops.views_per_item(t.purchases))


@query(with_sql(PURCHASES) + """
SELECT item_id FROM purchases ORDER BY md5('7:' || item_id), item_id LIMIT 1""")
def random_item(t: Tables):
    return ops.random_item(t.purchases, seed=7)


@query(with_sql(VIEWS) + """
SELECT user_id FROM (SELECT DISTINCT user_id FROM views) ORDER BY md5('7:' || user_id), user_id LIMIT 25""")
def random_users(t: Tables):
    """Drawn from the draws of two parts of the events."""
    odd = F.col("event_id") % 2 == 1
    parts = ops.drawn(t.views.where(odd), "user_id", 25, 7).unionAll(ops.drawn(t.views.where(~odd), "user_id", 25, 7))
    return ops.drawn(parts, "user_id", 25, 7)


@query("SELECT 1::BIGINT AS items, 0::BIGINT AS unknown")
def random_item_check(t: Tables):
    known = t.purchases.select("item_id", F.lit(1).alias("known")).distinct()
    return (ops.random_item(t.purchases, seed=7).join(known, "item_id", "left")
            .agg(F.count("*").alias("items"), F.count_if(F.col("known").isNull()).alias("unknown")))


@query(with_sql(PURCHASES, "c AS (SELECT user_id, item_id, count(*) AS r FROM purchases GROUP BY 1, 2)") + """
SELECT user_id, item_id, CAST(r > 0 AS INTEGER) AS p, 1.0::DOUBLE + 40.0::DOUBLE * r AS c FROM c""")
def preference_confidence(t: Tables):
    counted = t.purchases.groupBy("user_id", "item_id").agg(F.count("*").alias("r"))
    return counted.select("user_id", "item_id", preference(F.col("r")).alias("p"), confidence(F.col("r"), 40).alias("c"))
