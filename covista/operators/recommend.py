"""Ranked lists with metadata rules, boosts, exclusions and popularity back-fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.functions import settled
from covista.functions.columns import DEFAULT_BOOST
from covista.operators.product import best_scores
from covista.plans import as_array, top_k


def _texts(values: Sequence[str]):
    return F.array(*[F.lit(v) for v in values])


def item_rules(metadata: DataFrame, include: Sequence[str] = (), enhance: Sequence[str] = (),
               bias: float = DEFAULT_BOOST) -> DataFrame:
    """(candidate, boost) of the items that may be recommended.

    ``metadata(item_id, filters array)``. An empty ``include`` admits every item with
    metadata; items whose filters meet ``enhance`` get ``bias``.
    """
    allowed = metadata
    if include:
        allowed = allowed.where(F.arrays_overlap("filters", _texts(include)))
    boost = F.when(F.arrays_overlap("filters", _texts(enhance)), F.lit(float(bias))).otherwise(0.0) if enhance \
        else F.lit(0.0)
    return allowed.select(F.col("item_id").alias("candidate"), F.coalesce(boost, F.lit(0.0)).alias("boost"))


def ranked(scores: DataFrame, key: str, candidate: str, k: int, score: str = "score") -> DataFrame:
    """(key, rank, candidate, score): the k best non-zero scores per key, ties by id."""
    return (top_k(scores.where(F.col(score) != 0).select(key, candidate, score), [key],
                  [F.desc(settled(F.col(score))), F.asc(candidate)], k)
            .select(key, "rank", candidate, score))


def recommend(scores: DataFrame, keys: DataFrame, key: str, candidate: str, k: int, popular: DataFrame,
              metadata: DataFrame | None = None, include: Sequence[str] = (), enhance: Sequence[str] = (),
              bias: float = DEFAULT_BOOST, exclude: DataFrame | None = None, drop_self: bool = False,
              score: str = "score") -> DataFrame:
    """(key, rank, candidate, score, source): k items for every key.

    Scored items come first; free places go to the most popular items that are neither in
    the list, nor excluded, nor the key itself (source "popular", no score).
    ``keys`` has the column ``key``; ``popular(item_id, popularity)``; ``exclude(item_id)``.

    A boosted item is recommended even where its own score is 0. All such items of a key tie
    at ``bias``, below its boosted scored ones, so the k lowest ids that are not among the
    key's k best boosted scored items are all that can enter the list.
    """
    found = scores.select(F.col(key).alias("key"), F.col(candidate).alias("candidate"), F.col(score).alias("score"))
    found = found.where(F.col("score") != 0)
    if drop_self:
        found = found.where(F.col("key") != F.col("candidate"))
    banned = None if exclude is None else exclude.select(F.col("item_id").alias("candidate")).distinct()
    if banned is not None:
        found = found.join(banned, "candidate", "left_anti")
    # one entry per candidate, ordered as the list is: best rounded score first, then id
    entry = F.struct((-settled(F.col("score"))).alias("order"), "candidate", "score")
    order = [F.desc(settled(F.col("score"))), F.asc("candidate")]
    wanted = keys.select(F.col(key).alias("key")).distinct()
    with_rules = metadata is not None and (include or enhance)
    if with_rules:
        rules = item_rules(metadata, include, enhance, bias)
        if banned is not None:
            rules = rules.join(banned, "candidate", "left_anti")
        found = (found.join(rules, "candidate")
                 .select("key", "candidate", (F.col("score") + F.col("boost")).alias("score"),
                         (F.col("boost") != 0).alias("boosted")))
    else:
        found = found.withColumn("boosted", F.lit(False))
    # k boosted and k other candidates per key hold the k best of all
    best = top_k(found, ["key", "boosted"], order, k)
    packed = best.groupBy("key").agg(
        F.collect_list(F.when(F.col("boosted"), entry)).alias("boosted"),
        F.collect_list(F.when(~F.col("boosted"), entry)).alias("other"))
    none = F.array().cast("array<struct<order:double,candidate:bigint,score:double>>")
    lists = wanted.join(packed, "key", "left").select(
        "key", F.coalesce("boosted", none).alias("boosted"), F.coalesce("other", none).alias("other"))
    apart = (lambda i: i != F.col("key")) if drop_self else (lambda i: F.lit(True))

    listed = F.concat("boosted", "other")
    if with_rules and enhance:
        # up to k scored boosted items and the key itself can be skipped before k are found
        lists = lists.withColumn("pool", as_array(
            rules.where(F.col("boost") != 0), "candidate", [F.asc("candidate")], 2 * k + 1))
        have = F.transform("boosted", lambda e: e["candidate"])
        unscored = F.slice(F.filter("pool", lambda i: ~F.array_contains(have, i) & apart(i)), F.lit(1),
                           F.lit(k) - F.size("boosted"))
        listed = F.concat(listed, F.transform(unscored, lambda i: F.struct(
            F.lit(-float(bias)).alias("order"), i.alias("candidate"), F.lit(float(bias)).alias("score"))))
    lists = lists.select("key", F.slice(F.array_sort(listed), 1, k).alias("list"))

    pool = popular if banned is None else popular.join(
        banned.withColumnRenamed("candidate", "item_id"), "item_id", "left_anti")
    # at most k - 1 listed items and the key itself can be skipped
    lists = lists.withColumn("fill", as_array(
        pool, "item_id", [F.desc(settled(F.col("popularity"))), F.asc("item_id")], k + 1))
    taken = F.transform("list", lambda e: e["candidate"])
    free = F.filter("fill", lambda i: ~F.array_contains(taken, i) & apart(i))
    extra = F.transform(F.slice(free, F.lit(1), F.lit(k) - F.size("list")), lambda i: F.struct(
        i.cast("long").alias("candidate"), F.lit(None).cast("double").alias("score"), F.lit("popular").alias("source")))
    own = F.transform("list", lambda e: F.struct(
        e["candidate"].alias("candidate"), e["score"].alias("score"), F.lit("scored").alias("source")))
    return (lists.select("key", F.posexplode(F.concat(own, extra)).alias("place", "e"))
            .select(F.col("key").alias(key), (F.col("place") + 1).alias("rank"), F.col("e.candidate").alias(candidate),
                    F.col("e.score").alias(score), F.col("e.source").alias("source")))


def items_for_users(scores: DataFrame, users: DataFrame, k: int, popular: DataFrame, seen: DataFrame | None = None,
                    **rules) -> DataFrame:
    """Recommendations per user. Items already viewed stay in, unless ``seen`` is given; places
    left free are filled with popular items in either case."""
    if seen is not None:
        scores = scores.join(seen.select("user_id", "item_id").distinct(), ["user_id", "item_id"], "left_anti")
    return recommend(scores, users, "user_id", "item_id", k, popular, **rules)


def lists_for_users(a: DataFrame, s: DataFrame, users: DataFrame, k: int, popular: DataFrame, seen: DataFrame | None = None,
                    metadata: DataFrame | None = None, include: Sequence[str] = (), enhance: Sequence[str] = (),
                    bias: float = DEFAULT_BOOST, exclude: DataFrame | None = None) -> DataFrame:
    """``items_for_users`` from A and S themselves: only k scores per user (and k of boosted items) are made into rows."""
    parts = [s]
    if exclude is not None:
        parts = [s.join(exclude.select(F.col("item_id").alias("other_id")).distinct(), "other_id", "left_anti")]
    if metadata is not None and (include or enhance):
        rules = item_rules(metadata, include, enhance, bias).withColumnRenamed("candidate", "other_id")
        sides = [rules.where(F.col("boost") != 0), rules.where(F.col("boost") == 0)] if enhance else [rules]
        parts = [parts[0].join(side.select("other_id"), "other_id", "left_semi") for side in sides]
    scores = best_scores(a, parts[0], k, users, seen)
    for part in parts[1:]:
        scores = scores.unionByName(best_scores(a, part, k, users, seen))
    return recommend(scores, users, "user_id", "item_id", k, popular, metadata, include, enhance, bias, exclude)


def items_for_items(similarity: DataFrame, items: DataFrame, k: int, popular: DataFrame, **rules) -> DataFrame:
    """Similar items per item, never the item itself."""
    return recommend(similarity, items, "item_id", "other_id", k, popular, drop_self=True,
                     score="similarity", **rules)


def flatten(recommendations: DataFrame, key: str, item: str) -> DataFrame:
    """(key, item, rating, rank) from one array of (id, rating) structs per key."""
    return (recommendations.select(key, F.posexplode("recommendations").alias("place", "rec"))
            .select(key, F.col(f"rec.{item}").alias(item), F.col("rec.rating").alias("rating"),
                    (F.col("place") + 1).alias("rank")))
