"""User affinity A, predicted scores Y = A S, popularity by score and score statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.functions import half_life_weight, settled
from covista.functions.columns import DEFAULT_HALF_LIFE
from covista.plans import WORK_ROWS, fan_out_join


def affinity(df: DataFrame, t0: Column | float | None = None, half_life: float = DEFAULT_HALF_LIFE,
             weight: float = 1.0) -> DataFrame:
    """(user_id, item_id, affinity): summed half-life weights of a user's events per item.

    ``t0`` in epoch seconds; by default the newest event time. ``half_life=None`` counts
    every event as ``weight``.
    """
    if half_life is None:
        value = F.count("*") * F.lit(float(weight))
    else:
        if t0 is None:
            t0 = df.agg(F.max("event_time").cast("timestamp").cast("double").alias("t")).scalar()
        value = F.sum(half_life_weight(F.col("event_time"), t0, half_life, weight))
    return df.groupBy("user_id", "item_id").agg(value.alias("affinity"))


def affinity_state(df: DataFrame, half_life: float = DEFAULT_HALF_LIFE, weight: float = 1.0) -> DataFrame:
    """(user_id, item_id, weight, at): affinity of a slice of events as of its newest one, ``at`` in epoch seconds.

    States of any slices, in any order, merge with ``merged_states``; the events are not read again.
    """
    at = df.agg(F.max("event_time").cast("timestamp").cast("double").alias("t")).scalar()
    cells = affinity(df, at, half_life, weight)
    return cells.select("user_id", "item_id", F.col("affinity").alias("weight"), at.alias("at"))


def merged_states(first: DataFrame, *others: DataFrame, half_life: float = DEFAULT_HALF_LIFE) -> DataFrame:
    """One state of several: weights are brought to the newest reference time and added per cell.

    Associative and commutative up to rounding; partial sums are made before the shuffle.
    """
    rows = first
    for state in others:
        rows = rows.unionByName(state)
    at = rows.agg(F.max("at").alias("t")).scalar()
    return (rows.groupBy("user_id", "item_id").agg(F.sum(_aged("weight", "at", at, half_life)).alias("weight"))
            .select("user_id", "item_id", "weight", at.alias("at")))


def affinity_of(state: DataFrame, t0: Column | float | None = None, half_life: float = DEFAULT_HALF_LIFE) -> DataFrame:
    """(user_id, item_id, affinity) of a state as of ``t0`` (epoch seconds), by default of its own time."""
    value = F.col("weight") if t0 is None else _aged("weight", "at", t0, half_life)
    return state.select("user_id", "item_id", value.alias("affinity"))


def _aged(weight: str, at: str, t0: Column | float, half_life: float) -> Column:
    t0 = t0 if isinstance(t0, Column) else F.lit(float(t0))
    return F.col(weight) * F.pow(F.lit(2.0), -(t0 - F.col(at)) / F.lit(float(half_life)))


def predicted_scores(a: DataFrame, s: DataFrame, users: DataFrame | None = None,
                     work_rows: int = WORK_ROWS) -> DataFrame:
    """(user_id, item_id, score): Y = A S, optionally for some users only."""
    if users is not None:
        a = a.join(users.select("user_id").distinct(), "user_id", "left_semi")
    left = a.select("user_id", F.col("item_id").alias("_via"), "affinity")
    right = s.select(F.col("item_id").alias("_via"), F.col("other_id").alias("item_id"), "similarity")
    return (fan_out_join(left, right, ["_via"], ["user_id"], work_rows)
            .groupBy("user_id", "item_id")
            .agg(F.sum(F.col("affinity") * F.col("similarity")).alias("score")))


def score_lookup(a: DataFrame, s: DataFrame, wanted: DataFrame, work_rows: int = WORK_ROWS) -> DataFrame:
    """(user_id, item_id, score) for given pairs only; 0 where nothing was scored."""
    pairs = wanted.select("user_id", "item_id").distinct()
    steps = fan_out_join(a.select("user_id", F.col("item_id").alias("_via"), "affinity"), pairs,
                         ["user_id"], ["_via"], work_rows)
    links = s.select(F.col("item_id").alias("_via"), F.col("other_id").alias("item_id"), "similarity")
    found = (steps.join(links, ["_via", "item_id"]).groupBy("user_id", "item_id")
             .agg(F.sum(F.col("affinity") * F.col("similarity")).alias("score")))
    return (pairs.join(found, ["user_id", "item_id"], "left")
            .select("user_id", "item_id", F.coalesce("score", F.lit(0.0)).alias("score")))


def score_popularity(a: DataFrame, s: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """(item_id, popularity): column sums of Y for any similarity.

    Summing A per item first gives the same sums without building Y.
    """
    weight = a.groupBy("item_id").agg(F.sum("affinity").alias("_w"))
    totals = (s.join(weight, "item_id").groupBy(F.col("other_id").alias("item_id"))
              .agg(F.sum(F.col("_w") * F.col("similarity")).alias("popularity")))
    return _with_unscored(totals, items)


def count_score_popularity(a: DataFrame, pairs: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Column sums of Y when S = C counts the common viewers in ``pairs``, without building C.

    C = B'B for the user-item incidence B, so the sums are two joins along B: the weight of
    a history is the summed weight of its items, an item gets the weights of its viewers.
    """
    weight = a.groupBy("item_id").agg(F.sum("affinity").alias("_w"))
    by_user = pairs.join(weight, "item_id").groupBy("user_id").agg(F.sum("_w").alias("_h"))
    totals = pairs.join(by_user, "user_id").groupBy("item_id").agg(F.sum("_h").alias("popularity"))
    return _with_unscored(totals, items)


def _with_unscored(totals: DataFrame, items: DataFrame | None) -> DataFrame:
    if items is None:
        return totals
    return (items.select("item_id").distinct().join(totals, "item_id", "left")
            .select("item_id", F.coalesce("popularity", F.lit(0.0)).alias("popularity")))


def popular_by_score(popularity: DataFrame, n: int, exclude: DataFrame | None = None) -> DataFrame:
    """The n items with the largest summed score; fewer when fewer exist."""
    if exclude is not None:
        popularity = popularity.join(exclude.select("item_id"), "item_id", "left_anti")
    return popularity.orderBy(F.desc(settled(F.col("popularity"))), "item_id").limit(n)


def user_score_stats(scores: DataFrame, item_count: Column | int) -> DataFrame:
    """(user_id, mean_score, max_score) over all items, unscored ones counting as 0."""
    n = item_count if isinstance(item_count, Column) else F.lit(item_count)
    return scores.groupBy("user_id").agg(
        (F.sum("score") / n).alias("mean_score"),
        F.greatest(F.max("score"), F.lit(0.0)).alias("max_score"))


def unseen_scored(scores: DataFrame, pairs: DataFrame) -> DataFrame:
    """(user_id, item_id, score) with a non-zero score for items the user never viewed."""
    return scores.where(F.col("score") != 0).join(pairs, ["user_id", "item_id"], "left_anti")
