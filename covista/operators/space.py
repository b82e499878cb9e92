"""Users as points among the item vectors: placement, relocation, nearest items."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.functions import bounded_prediction, euclidean, move_towards, settled
from covista.operators.vectors import similar_by_distance
from covista.plans import search, top_k

ALPHA = 0.6


def mean_vector(items: DataFrame) -> DataFrame:
    """One row: the mean of all item vectors."""
    return items.where(F.col("vector").isNotNull()).agg(
        vector_to_array(Summarizer.mean(array_to_vector(F.col("vector")))).alias("vector"))


def placed_users(users: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, vector): every user at the item mean."""
    return users.select("user_id").distinct().withColumn("vector", mean_vector(items).scalar())


def _summed(weights: DataFrame, items: DataFrame, name: str, mean: bool = False) -> DataFrame:
    """Weighted sum (or plain mean) of the vectors of a user's items."""
    vectors = items.where(F.col("vector").isNotNull()).select("item_id", "vector")
    # one vector per item: a plain lookup, which adaptive execution broadcasts when the
    # catalogue is small and splits where an item is hot
    joined = weights.join(vectors, "item_id")
    column = array_to_vector(F.col("vector"))
    value = Summarizer.mean(column) if mean else Summarizer.sum(column, F.col("weight"))
    return joined.groupBy("user_id").agg(vector_to_array(value).alias(name))


def user_means(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, vector): mean vector of the distinct items each user viewed."""
    return _summed(pairs, items, "vector", mean=True)


def relocation_state(df: DataFrame, items: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(user_id, n, moved): the moves of each user's n events as one map x -> (1 - alpha)^n x + moved.

    moved = sum of alpha (1 - alpha)^j v_j, where j counts back from the newest event; null stands for zero.
    Only as many events per user are ranked as have a weight that is not exactly 0.0 in double precision,
    so a very long history is never sorted in one task. Events of items without a vector are left out.
    """
    known = items.where(F.col("vector").isNotNull())
    events = df.join(known.select("item_id"), "item_id", "left_semi").select("user_id", "item_id", "event_time")
    stay = 1.0 - alpha
    if stay <= 0:
        deepest = 1
    elif stay >= 1:
        deepest = 0
    else:
        deepest = math.ceil(1075 * math.log(2) / -math.log(stay)) + 1
    out = events.groupBy("user_id").agg(F.count("*").alias("n"))
    if not deepest:
        return out.withColumn("moved", F.lit(None).cast("array<double>"))
    newest = top_k(events, ["user_id"], [F.desc("event_time"), F.desc("item_id")], deepest, rank="back")
    weights = (newest.withColumn("weight", F.lit(alpha) * F.pow(F.lit(stay), F.col("back") - 1))
               .groupBy("user_id", "item_id").agg(F.sum("weight").alias("weight")))
    return out.join(_summed(weights, items, "moved"), "user_id", "left")


def composed(earlier: DataFrame, later: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """The state of two slices of time, every event of ``later`` after those of ``earlier``: kept states take in new
    events without the old ones. Associative, so slices may be composed in any grouping that keeps their order."""
    # names of their own: inside a lambda, Spark takes a name of the select list before one of the input
    a = earlier.select("user_id", F.col("n").alias("_n1"), F.col("moved").alias("_moved1"))
    b = later.select("user_id", F.col("n").alias("_n2"), F.col("moved").alias("_moved2"))
    n1, n2 = F.coalesce("_n1", F.lit(0)), F.coalesce("_n2", F.lit(0))
    shrunk = F.transform("_moved1", lambda x: x * F.pow(F.lit(1.0 - alpha), n2))
    moved = (F.when(F.col("_moved1").isNull(), F.col("_moved2")).when(F.col("_moved2").isNull(), shrunk)
             .otherwise(F.zip_with(shrunk, "_moved2", lambda x, y: x + y)))
    return a.join(b, "user_id", "full").select("user_id", (n1 + n2).alias("n"), moved.alias("moved"))


def placed_by(state: DataFrame, items: DataFrame, alpha: float = ALPHA, users: DataFrame | None = None) -> DataFrame:
    """(user_id, vector): the maps of a state applied to the item mean; ``users`` without events stay there."""
    if users is not None:
        state = users.select("user_id").distinct().join(state, "user_id", "full")
    state = state.withColumn("mean", mean_vector(items).scalar())
    origin = F.transform("mean", lambda m: m * F.pow(F.lit(1.0 - alpha), F.coalesce("n", F.lit(0))))
    vector = F.zip_with(origin, "moved", lambda a, b: a + b)
    return state.select("user_id", F.when(F.col("moved").isNull(), origin).otherwise(vector).alias("vector"))


def relocated_users(df: DataFrame, items: DataFrame, alpha: float = ALPHA, users: DataFrame | None = None) -> DataFrame:
    """(user_id, vector): users start at the item mean and move by x + alpha (v - x) towards
    each viewed item, in time order, by the closed form of ``relocation_state``."""
    return placed_by(relocation_state(df, items, alpha), items, alpha, users)


def relocated_in_batch(pairs: DataFrame, items: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(user_id, vector): one step from the item mean towards the mean of the viewed items."""
    means = user_means(pairs, items).withColumn("mean", mean_vector(items).scalar())
    return means.select("user_id", move_towards(F.col("mean"), F.col("vector"), alpha).alias("vector"))


def points(users: DataFrame, items: DataFrame) -> DataFrame:
    """(id, type, vector) of users and items together."""
    return (users.select(F.col("user_id").alias("id"), F.lit("user").alias("type"), "vector")
            .unionByName(items.select(F.col("item_id").alias("id"), F.lit("item").alias("type"), "vector")))


def _require(items: DataFrame, n: int) -> None:
    if items.where(F.col("vector").isNotNull()).limit(n).count() < n:
        raise ValueError(f"fewer than {n} items to choose from")


def nearest_items_to_users(users: DataFrame, items: DataFrame, n: int, **tuning) -> DataFrame:
    """(user_id, rank, item_id, distance): the n nearest items of every user."""
    _require(items, n)
    hits = search(users.select(F.col("user_id").alias("seed_id"), "vector"), items, k=n, **tuning)
    return hits.select(F.col("seed_id").alias("user_id"), "rank", "item_id", F.col("cost").alias("distance"))


def nearest_items_to_items(items: DataFrame, n: int, seeds: DataFrame | None = None, **tuning) -> DataFrame:
    """(item_id, rank, other_id, distance): the n nearest other items of every item."""
    _require(items, n + 1)
    return similar_by_distance(items, n, seeds, **tuning).drop("difference")


def predictions(test: DataFrame, users: DataFrame, items: DataFrame, radius: float) -> DataFrame:
    """(user_id, item_id, distance, predicted): 1 where the item lies within ``radius``."""
    where = items.select("item_id", F.col("vector").alias("_v"))
    rows = test.select("user_id", "item_id").join(users.select("user_id", "vector"), "user_id")
    rows = rows.join(where, "item_id").withColumn("distance", euclidean(F.col("vector"), F.col("_v")))
    return rows.select("user_id", "item_id", "distance", bounded_prediction(settled(F.col("distance")), radius).alias("predicted"))


def prediction_error(test: DataFrame, users: DataFrame, items: DataFrame, radius: float) -> DataFrame:
    """One row: mean signed and mean absolute error; every test row has the true value 1."""
    gap = 1 - F.col("predicted")
    return predictions(test, users, items, radius).agg(
        F.count("*").alias("tested"), F.avg(gap).alias("error"), F.avg(F.abs(gap)).alias("absolute_error"))
