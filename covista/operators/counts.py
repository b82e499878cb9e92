"""View counts, viewer lists, histories, rankings, popular items, cold start."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covista.plans import as_array
from covista.sources.tables import latest_interactions

LIST_ROWS = 100_000


def distinct_pairs(df: DataFrame) -> DataFrame:
    """(user_id, item_id), each once. The functions that take ``pairs`` expect this frame;
    store it (``covista.plans.stored``) when several of them are to use it."""
    return df.select("user_id", "item_id").distinct()


def views_per_item(df: DataFrame) -> DataFrame:
    return df.groupBy("item_id").agg(F.count("*").alias("views"))


def viewers_per_item(pairs: DataFrame) -> DataFrame:
    """Distinct viewers of every item."""
    return pairs.groupBy("item_id").agg(F.count("*").alias("viewers"))


def _lists(pairs: DataFrame, key: str, member: str, name: str, list_rows: int) -> DataFrame:
    sizes = pairs.groupBy(key).agg(F.count("*").alias("_n"))
    parts = F.ceil(F.col("_n") / F.lit(list_rows)).cast("int")
    return (pairs.join(sizes, key)
            .withColumn("part", F.pmod(F.xxhash64(member), parts).cast("int"))
            .groupBy(key, "part").agg(F.array_sort(F.collect_list(member)).alias(name)))


def viewer_sets(pairs: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """(item_id, part, viewers): sorted distinct viewers.

    An item with more than ``list_rows`` viewers gets several parts of about that size, so
    no single array grows with the data.
    """
    return _lists(pairs, "item_id", "user_id", "viewers", list_rows)


def histories(pairs: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """(user_id, part, items): sorted distinct items, in parts like ``viewer_sets``."""
    return _lists(pairs, "user_id", "item_id", "items", list_rows)


def history_rows(lists: DataFrame) -> DataFrame:
    """Histories back to one (user_id, item_id) row each."""
    return lists.select("user_id", F.explode("items").alias("item_id"))


def viewers_of_any(df: DataFrame) -> DataFrame:
    return df.select("user_id").distinct()


def non_viewers(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, non_viewers): users with a history who did not view the item.

    A count, from the number of users and of viewers; the pairs themselves are users x items.
    """
    users = pairs.agg(F.countDistinct("user_id").alias("n")).scalar()
    return (items.join(viewers_per_item(pairs), "item_id", "left")
            .select("item_id", (users - F.coalesce("viewers", F.lit(0))).alias("non_viewers")))


def users_without(df: DataFrame, item_id: int) -> DataFrame:
    """Users with a history who did not view this item."""
    viewed = df.where(F.col("item_id") == item_id).select("user_id").distinct()
    return viewers_of_any(df).join(viewed, "user_id", "left_anti")


def interactions_used(pairs: DataFrame) -> DataFrame:
    """One row: the number of distinct (user, item) pairs."""
    return pairs.agg(F.count("*").alias("pairs"))


def item_ranking(views: DataFrame, ascending: bool = False) -> DataFrame:
    """(item_id, views, ranking): dense rank of the view count, 1 = most viewed.

    Only the distinct counts are ranked in one task. Positive integers that sum to E views
    have at most sqrt(2E) distinct values.
    """
    order = F.asc("views") if ascending else F.desc("views")
    levels = views.select("views").distinct().withColumn("ranking", F.row_number().over(Window.orderBy(order)))
    return views.join(levels, "views").select("item_id", "views", "ranking")


def update_ranking(df: DataFrame, batch_size: int, ties=("user_id", "item_id")) -> DataFrame:
    """Item ranking over the newest ``batch_size`` events."""
    return item_ranking(views_per_item(latest_interactions(df, batch_size, ties)))


def ranked_popular(ranking: DataFrame, n: int) -> DataFrame:
    """The n best ranked items of a stored ranking."""
    return ranking.orderBy("ranking", "item_id").limit(n)


def popular(df: DataFrame, n: int, batch_size: int | None = None, ties=("user_id", "item_id")) -> DataFrame:
    """The n most viewed items, of all events or of the newest ``batch_size``."""
    df = df if batch_size is None else latest_interactions(df, batch_size, ties)
    return views_per_item(df).orderBy(F.desc("views"), "item_id").limit(n)


def cold_start(users: DataFrame, df: DataFrame, n: int, batch_size: int | None = None,
               ties=("user_id", "item_id")) -> DataFrame:
    """(user_id, rank, item_id): the popular items for users without any event."""
    newcomers = users.select("user_id").distinct().join(df.select("user_id").distinct(), "user_id", "left_anti")
    best = popular(df, n, batch_size, ties)
    ids = as_array(best, "item_id", [F.desc("views"), F.asc("item_id")], n)
    return (newcomers.select("user_id", F.posexplode(ids).alias("place", "item_id"))
            .select("user_id", (F.col("place") + 1).alias("rank"), "item_id"))


def most_viewed(views: DataFrame) -> DataFrame:
    """The single item with the most views, lowest id on ties; merges on the map side."""
    best = F.min(F.struct((-F.col("views")).alias("v"), F.col("item_id").alias("i"))).alias("best")
    return views.agg(best).select(F.col("best.i").alias("item_id"), (-F.col("best.v")).alias("views"))


def draw_key(key: Column, seed: int) -> Column:
    """A value that orders keys at random, the same for a key and seed wherever and whenever it is computed."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def drawn(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n distinct values of ``key`` at random: those with the smallest draw keys. Unlike a sort by random numbers
    the draw does not depend on partitioning or on tasks run again, and draws of parts merge: the draw of a
    table is the draw from the draws of its parts."""
    return (df.where(F.col(key).isNotNull()).select(key).distinct()
            .orderBy(draw_key(F.col(key), seed), key).limit(n))


def random_item(df: DataFrame, seed: int | None = None) -> DataFrame:
    """One item, each of the distinct ones alike; the same for a seed. A minimum, merged on the map side."""
    seed = secrets.randbelow(1 << 31) if seed is None else seed
    first = F.min(F.struct(draw_key(F.col("item_id"), seed).alias("k"), F.col("item_id").alias("i"))).alias("first")
    return (df.where(F.col("item_id").isNotNull()).agg(first).where(F.col("first").isNotNull())
            .select(F.col("first.i").alias("item_id")))
