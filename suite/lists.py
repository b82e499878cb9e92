"""Ranked recommendation lists with rules and back-fill."""

from __future__ import annotations

from pyspark.sql import functions as F

from covista.operators import affinity as aff
from covista.operators import catalogue, recommend
from covista.operators import cooccurrence as cooc
from covista.operators.product import best_scores
from covista.operators.vectors import rated_titles
from covista.plans import stored
from suite.cooccurrence import SCORED
from suite.registry import query
from suite.tables import CELLS, HALF_LIFE, METADATA, PURCHASES, VIEW_PAIRS, VIEWS, Tables, affinity_sql, with_sql

K = 10
INCLUDE = ("SMALL", "MEDIUM", "Brand#1", "Brand#2", "Brand#3")
ENHANCE = ("Brand#1", "MEDIUM")
SCARCE = ("Brand#5", "Brand#6")
POPULAR = """popular AS (
  SELECT item_id, row_number() OVER (ORDER BY round(sum(score), 9) DESC, item_id) AS place FROM scores GROUP BY 1)"""


def _quoted(values):
    return ", ".join(f"'{v}'" for v in values)


def _lists_sql(key: str, candidate: str, base: str, rules: str = "", boost: str = "0.0", banned: str = "",
               drop_self: bool = False, value: str = "score") -> str:
    """The expected lists over every key x item, including items that scored 0."""
    own = "AND k.key <> i.item_id" if drop_self else ""
    join = "JOIN metadata m ON m.item_id = i.item_id" if rules or boost != "0.0" else ""
    ban = f"AND i.item_id NOT IN ({banned})" if banned else ""
    fill_ban = f"AND p.item_id NOT IN ({banned})" if banned else ""
    fill_own = "AND p.item_id <> k.key" if drop_self else ""
    return f"""
base AS ({base}),
row_of AS (
  SELECT k.key, i.item_id AS cand, coalesce(b.score, 0.0) + {boost} AS score
  FROM keys k CROSS JOIN all_items i {join}
  LEFT JOIN base b ON b.key = k.key AND b.cand = i.item_id
  WHERE true {own} {ban} {rules}),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY round(score, 9) DESC, cand) AS rank
                 FROM row_of WHERE score <> 0) WHERE rank <= {K}),
have AS (SELECT k.key, count(b.key) AS n FROM keys k LEFT JOIN best b ON b.key = k.key GROUP BY 1),
fill AS (
  SELECT k.key, p.item_id AS cand, row_number() OVER (PARTITION BY k.key ORDER BY p.place) AS f
  FROM keys k CROSS JOIN popular p
  WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.key = k.key AND b.cand = p.item_id) {fill_own} {fill_ban})
SELECT key AS {key}, rank, cand AS {candidate}, round(score, 6) AS {value}, 'scored' AS source FROM best
UNION ALL
SELECT f.key, h.n + f.f, f.cand, NULL, 'popular' FROM fill f JOIN have h ON h.key = f.key WHERE h.n + f.f <= {K}"""


ITEMS = "all_items AS (SELECT p_partkey AS item_id FROM part)"
VIEW_USERS = "keys AS (SELECT DISTINCT user_id AS key FROM views)"
VIEW_ITEMS = "keys AS (SELECT DISTINCT item_id AS key FROM views)"
USER_BASE = "SELECT user_id AS key, item_id AS cand, score FROM scores"
ITEM_BASE = "SELECT item_id AS key, other_id AS cand, CAST(n AS DOUBLE) AS score FROM cells"
FIXED = (*SCORED, POPULAR, METADATA, ITEMS)


class _Model:
    def __init__(self, t: Tables):
        self.pairs = t.view_pairs
        self.affinity = stored(aff.affinity(t.views, half_life=HALF_LIFE), "affinity")
        self.similarity = cooc.item_similarity(cooc.cooccurrence(self.pairs))
        self.popular = aff.count_score_popularity(self.affinity, self.pairs)
        self.users = self.pairs.select("user_id").distinct()
        self.items = self.pairs.select("item_id").distinct()


def _rounded(df, score: str):
    return df.withColumn("rank", F.col("rank").cast("long")).withColumn(score, F.round(score, 6))


@query(with_sql(*FIXED, VIEW_ITEMS) + "," + _lists_sql("item_id", "other_id", ITEM_BASE, drop_self=True, value="similarity"))
def similar_viewed_items(t: Tables):
    m = _Model(t)
    return _rounded(recommend.items_for_items(m.similarity, m.items, K, m.popular), "similarity")


@query(with_sql(*FIXED, "keys AS (SELECT p_partkey AS key FROM part)") + "," + _lists_sql(
    "item_id", "other_id", ITEM_BASE, drop_self=True, value="similarity"))
def similar_items_of_catalogue(t: Tables):
    """Every part asks; parts nobody viewed get popular items only."""
    m = _Model(t)
    keys = t.read("part").select(F.col("p_partkey").alias("item_id"))
    return _rounded(recommend.items_for_items(m.similarity, keys, K, m.popular), "similarity")


@query(with_sql(*FIXED, VIEW_ITEMS) + "," + _lists_sql(
    "item_id", "other_id", ITEM_BASE, drop_self=True, value="similarity",
    rules=f"AND (m.p_type IN ({_quoted(SCARCE)}) OR m.p_brand IN ({_quoted(SCARCE)}))",
    banned="SELECT p_partkey FROM part WHERE p_size > 45"))
def similar_items_included(t: Tables):
    m = _Model(t)
    banned = t.read("part").where(F.col("p_size") > 45).select(F.col("p_partkey").alias("item_id"))
    out = recommend.items_for_items(m.similarity, m.items, K, m.popular, metadata=t.metadata,
                                    include=SCARCE, exclude=banned)
    return _rounded(out, "similarity")


BOOST = f"CASE WHEN m.p_type IN ({_quoted(ENHANCE)}) OR m.p_brand IN ({_quoted(ENHANCE)}) THEN 10.0 ELSE 0.0 END"


@query(with_sql(*FIXED, VIEW_ITEMS) + "," + _lists_sql(
    "item_id", "other_id", ITEM_BASE, drop_self=True, value="similarity", boost=BOOST))
def similar_items_boosted(t: Tables):
    m = _Model(t)
    out = recommend.items_for_items(m.similarity, m.items, K, m.popular, metadata=t.metadata, enhance=ENHANCE)
    return _rounded(out, "similarity")


@query(with_sql(*FIXED, VIEW_USERS) + "," + _lists_sql("user_id", "item_id", USER_BASE))
def items_for_users(t: Tables):
    m = _Model(t)
    return _rounded(recommend.lists_for_users(m.affinity, m.similarity, m.users, K, m.popular), "score")


@query(with_sql(*FIXED, "keys AS (SELECT c_custkey AS key FROM customer)") + "," + _lists_sql(
    "user_id", "item_id", USER_BASE, boost=BOOST.replace("10.0", "0.5"),
    rules=f"AND (m.p_type IN ({_quoted(INCLUDE)}) OR m.p_brand IN ({_quoted(INCLUDE)}))"))
def items_for_users_ruled(t: Tables):
    """Every customer, with include rules and a small boost."""
    m = _Model(t)
    users = t.read("customer").select(F.col("c_custkey").alias("user_id"))
    out = recommend.lists_for_users(m.affinity, stored(m.similarity, "similarity"), users, K, m.popular, metadata=t.metadata,
                                    include=INCLUDE, enhance=ENHANCE, bias=0.5)
    return _rounded(out, "score")


@query(with_sql(*SCORED, """fresh AS (
  SELECT s.* FROM scores s WHERE NOT EXISTS (
    SELECT 1 FROM pairs p WHERE p.user_id = s.user_id AND p.item_id = s.item_id))""", """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM fresh)""") + f"""
SELECT user_id, rank, item_id, round(score, 6) AS score FROM numbered WHERE rank <= {K}""")
def unseen_items_for_users(t: Tables):
    m = _Model(t)
    out = recommend.ranked(best_scores(m.affinity, m.similarity, K, seen=m.pairs), "user_id", "item_id", K)
    return _rounded(out, "score")


SUMMED = "summed AS (SELECT user_id, item_id, sum(rating) AS rating FROM purchases GROUP BY 1, 2)"


@query(with_sql(PURCHASES, SUMMED, """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM summed)""") + f"""
SELECT user_id, rank, item_id, rating FROM numbered WHERE rank <= {K}""")
def top_items_per_user(t: Tables):
    rated = t.purchases.groupBy("user_id", "item_id").agg(F.sum("rating").alias("rating"))
    return recommend.ranked(rated, "user_id", "item_id", K, "rating").withColumn("rank", F.col("rank").cast("long"))


@query(with_sql(PURCHASES, SUMMED, """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rating DESC, user_id) AS rank FROM summed)""") + f"""
SELECT item_id, rank, user_id, rating FROM numbered WHERE rank <= {K}""")
def top_users_per_item(t: Tables):
    rated = t.purchases.groupBy("user_id", "item_id").agg(F.sum("rating").alias("rating"))
    return recommend.ranked(rated, "item_id", "user_id", K, "rating").withColumn("rank", F.col("rank").cast("long"))


@query(with_sql(PURCHASES, SUMMED, """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM summed)""") + """
SELECT user_id, rank, item_id, rating, p_name AS title FROM numbered LEFT JOIN part ON p_partkey = item_id WHERE rank <= 5""")
def best_rated_titles(t: Tables):
    rated = t.purchases.groupBy("user_id", "item_id").agg(F.sum("rating").alias("rating"))
    movies = t.read("part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    return rated_titles(rated, movies, 5).withColumn("rank", F.col("rank").cast("long"))


@query(with_sql(
    VIEWS, VIEW_PAIRS, CELLS, METADATA, """numbered AS (
  SELECT item_id, other_id, n, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, other_id) AS rank
  FROM cells WHERE item_id <> other_id)""") + """
SELECT x.item_id, rank, x.other_id, title, p_type AS genre, p_brand AS provider
FROM numbered x LEFT JOIN metadata m ON m.item_id = x.other_id WHERE rank <= 10""")
def described_lists(t: Tables):
    cells = cooc.cooccurrence(t.view_pairs, diagonal=False)
    best = recommend.ranked(cells, "item_id", "other_id", K, "both")
    meta = t.metadata.select(F.col("item_id").alias("other_id"), "title", F.col("filters")[0].alias("genre"),
                             F.col("filters")[1].alias("provider"))
    return catalogue.describe(best, meta, "other_id").select(
        "item_id", F.col("rank").cast("long").alias("rank"), "other_id", "title", "genre", "provider")


@query(with_sql(VIEWS, VIEW_PAIRS, affinity_sql(), """lists AS (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY round(a, 9) DESC, item_id) AS rank, a
  FROM affinity)""") + """
SELECT user_id, item_id, round(a, 6) AS rating, rank FROM lists WHERE rank <= 10""")
def flattened_lists(t: Tables):
    """One array of (item, rating) structs per user, and back to rows."""
    best = recommend.ranked(aff.affinity(t.views, half_life=HALF_LIFE), "user_id", "item_id", K, "affinity")
    entry = F.struct("rank", "item_id", F.col("affinity").alias("rating"))
    packed = best.groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("recommendations"))
    return recommend.flatten(packed, "user_id", "item_id").select(
        "user_id", "item_id", F.round("rating", 6).alias("rating"), F.col("rank").cast("long").alias("rank"))
