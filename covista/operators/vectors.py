"""Item-to-item, user-to-item and radius queries over vector tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.operators.recommend import ranked
from covista.plans import search


def _seeds(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("seed_id"), "vector")


def similar_by_distance(items: DataFrame, k: int, seeds: DataFrame | None = None, **tuning) -> DataFrame:
    """(item_id, rank, other_id, distance, difference): the k items with the nearest vectors.

    ``items(item_id, vector)``; all items are seeds unless ``seeds`` is given. The item itself
    is not returned. ``difference`` is the squared distance.
    """
    hits = search(_seeds(items if seeds is None else seeds, "item_id"), items, k=k, exclude_self=True, **tuning)
    return hits.select(F.col("seed_id").alias("item_id"), "rank", F.col("item_id").alias("other_id"),
                       F.col("cost").alias("distance"), (F.col("cost") * F.col("cost")).alias("difference"))


def _with_vectorless(hits: DataFrame, seeds: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Fill lists shorter than k with items that have no vector, at score 0, lowest ids first."""
    bare = items.where(F.col("vector").isNull()).select(F.col("item_id").cast("long").alias("id")).orderBy("id").limit(k + 1)
    ids = bare.agg(F.array_sort(F.collect_list("id")).alias("ids")).scalar()
    have = hits.groupBy("seed_id").agg(F.count("*").cast("int").alias("n"))
    short = (seeds.where(F.col("vector").isNotNull()).select("seed_id").join(have, "seed_id", "left")
             .withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < k))
    extra = short.select("seed_id", "n", F.posexplode(F.slice(ids, F.lit(1), F.lit(k) - F.col("n"))).alias("p", "item_id"))
    return hits.unionByName(extra.select("seed_id", "item_id", F.lit(0.0).alias("score"),
                                         (F.col("n") + F.col("p") + 1).alias("rank")))


def similar_by_cosine(items: DataFrame, k: int, seeds: DataFrame | None = None, where: Column | None = None,
                      vectorless: bool = False, **tuning) -> DataFrame:
    """(item_id, rank, other_id, score): the k best by cosine + 1 among the items that pass
    the filter ``where`` (a condition on the item columns), without the item itself.

    With ``vectorless`` items without a vector count as score 0.
    """
    start = _seeds(items if seeds is None else seeds, "item_id")
    pool = items if where is None else items.where(where)
    hits = search(start, pool, k=k, metric="cosine", exclude_self=True, **tuning)
    hits = hits.select("seed_id", "item_id", (1 - F.col("cost")).alias("score"), "rank")
    if vectorless:
        hits = _with_vectorless(hits, start, pool, k)
    return hits.select(F.col("seed_id").alias("item_id"), "rank", F.col("item_id").alias("other_id"), "score")


def items_by_product(users: DataFrame, items: DataFrame, k: int, where: Column | None = None,
                     vectorless: bool = False, **tuning) -> DataFrame:
    """(user_id, rank, item_id, score): the k best by 1 / (1 + e^-product) for every user."""
    start = _seeds(users, "user_id")
    pool = items if where is None else items.where(where)
    hits = search(start, pool, k=k, metric="dot", **tuning)
    hits = hits.select("seed_id", "item_id", (1 / (1 + F.exp("cost"))).alias("score"), "rank")
    if vectorless:
        hits = _with_vectorless(hits, start, pool, k)
    return hits.select(F.col("seed_id").alias("user_id"), "rank", "item_id", "score")


def points_within(centres: DataFrame, points: DataFrame, radius: float, kind: str = "item",
                  truncate: int | None = None, **tuning) -> DataFrame:
    """(centre_id, id, distance): points of one type within ``radius`` of each centre.

    ``points(id, type, vector)``, ``centres(id, vector)``. ``truncate`` keeps the nearest n.
    """
    pool = points.where(F.col("type") == kind).select(F.col("id").alias("item_id"), "vector")
    hits = search(centres.select(F.col("id").alias("seed_id"), "vector"), pool, k=truncate, radius=radius, **tuning)
    return hits.select(F.col("seed_id").alias("centre_id"), F.col("item_id").alias("id"), F.col("cost").alias("distance"))


def rated_titles(ratings: DataFrame, movies: DataFrame, k: int) -> DataFrame:
    """(user_id, rank, item_id, rating, title): every user's k best-rated titles."""
    best = ranked(ratings, "user_id", "item_id", k, score="rating")
    return best.join(movies.select("item_id", "title"), "item_id", "left").select(
        "user_id", "rank", "item_id", "rating", "title")


def recommendation_report(rated: DataFrame, recommended: DataFrame, movies: DataFrame) -> DataFrame:
    """(user_id, part, rank, item_id, title, score): what the user rated best ("rated") and
    what is recommended ("recommended")."""
    new = recommended.join(movies.select("item_id", "title"), "item_id", "left")
    columns = ["user_id", "part", "rank", "item_id", "title", "score"]
    return (rated.withColumnRenamed("rating", "score").withColumn("part", F.lit("rated")).select(columns)
            .unionByName(new.withColumn("part", F.lit("recommended")).select(columns)))
