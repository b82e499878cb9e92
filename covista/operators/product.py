"""The best cells of each row of Y = A S, and statistics of its rows, without making Y.

Columns of S are put in blocks of bounded size, by the power of two of their largest similarity. A user's
score in a block is at most the sum of affinities times the largest similarity of each viewed item there; blocks
that cannot reach the user's k best are left out before any score is made. A block of users and a block of columns
meet in one task, which hands on k cells per user. No row is keyed by (user, item) before that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covista.functions import settled
from covista.plans import fan_out_join, stored, top_k

# cells of S in a block of columns, rows of A in a block of users
BLOCK_CELLS = 200_000
USER_CELLS = 500_000
BLOCK = ["_users", "_level", "_part"]


def _solver(k: int):
    """Scores of a block of users for a block of columns; the k best non-zero ones per user, ties by id."""

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        columns, column = np.unique(right["item_id"].to_numpy(), return_inverse=True)
        order = np.argsort(right["_via"].to_numpy(), kind="stable")
        similarity, column = right["similarity"].to_numpy()[order], column[order]
        vias, first, length = np.unique(right["_via"].to_numpy()[order], return_index=True, return_counts=True)
        by_user = np.argsort(left["user_id"].to_numpy(), kind="stable")
        left_users, via = left["user_id"].to_numpy()[by_user], left["_via"].to_numpy()[by_user]
        weight, seen = left["affinity"].to_numpy()[by_user], left["_seen"].to_numpy(zero_copy_only=False)[by_user]
        users, start = np.unique(left_users, return_index=True)
        found = []
        for user, a, b in zip(users, start, [*start[1:], len(left_users)]):
            own = ~seen[a:b]
            at = np.searchsorted(vias, via[a:b][own])
            n = length[at]
            cells = np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            score = np.bincount(column[cells], np.repeat(weight[a:b][own], n) * similarity[cells], len(columns))
            score[np.isin(columns, via[a:b][~own])] = 0.0
            hit = np.flatnonzero(score)
            value = np.rint(score[hit] * 1e9) / 1e9  # as ``settled``
            if len(hit) > k:
                near = value >= np.partition(value, len(hit) - k)[len(hit) - k]
                hit, value = hit[near], value[near]
            hit = hit[np.lexsort((columns[hit], -value))[:k]]
            found.append((np.full(len(hit), user), columns[hit], score[hit]))
        parts = zip(*found) if found else ([], [], [])
        empty = (users[:0], columns[:0], similarity[:0])
        return pa.table({name: np.concatenate([none, *part]) for name, none, part in
                         zip(("user_id", "item_id", "score"), empty, parts)})

    return solve


def _floors(a: DataFrame, cells: DataFrame, k: int, seen: DataFrame | None) -> DataFrame:
    """(user_id, _floor): a score that at least k items reach, for non-negative factors.

    With the r-th largest similarity of a viewed item, r items score at least affinity times that. r is k; with
    ``seen`` the first of k, 2k, 4k, … that leaves k items after all seen ones are gone.
    """
    if seen is None:
        least = top_k(cells, ["_via"], [F.desc("similarity")], k, "_r").where(F.col("_r") == k)
        reached = a.join(least.select("_via", F.col("similarity").alias("_least")), "_via")
    else:
        place = F.row_number().over(Window.partitionBy("_via").orderBy(F.desc("similarity")))
        doublings = F.log2(F.col("_r") / k)
        least = (cells.withColumn("_r", place).where(doublings == F.floor(doublings))
                 .select("_via", "_r", F.col("similarity").alias("_least")))
        gone = seen.groupBy("user_id").agg(F.count("*").alias("_gone"))
        reached = (a.join(gone, "user_id", "left").join(least, "_via")
                   .where(F.col("_r") >= k + F.coalesce("_gone", F.lit(0))))
    return reached.groupBy("user_id").agg(F.max(F.col("affinity") * F.col("_least")).alias("_floor"))


def best_scores(a: DataFrame, s: DataFrame, k: int, users: DataFrame | None = None, seen: DataFrame | None = None,
                block_cells: int = BLOCK_CELLS, user_cells: int = USER_CELLS) -> DataFrame:
    """(user_id, item_id, score): the k best non-zero scores of Y = A S per user, ties by item id.

    ``a(user_id, item_id, affinity)`` and ``s(item_id, other_id, similarity)`` have a row per cell; rows with a null take
    no part. ``users(user_id)`` limits the users, ``seen(user_id, item_id)`` are cells that are not wanted. Bounds need
    factors of 0 and more; with a negative one no block is left out. The result is the same.
    """
    if users is not None:
        a = a.join(users.select("user_id").distinct(), "user_id", "left_semi")
    a = stored(a.select("user_id", F.col("item_id").alias("_via"), F.col("affinity").cast("double")).dropna(), "rows")
    top = F.max("similarity").over(Window.partitionBy("item_id"))
    cells = (s.select(F.col("item_id").alias("_via"), F.col("other_id").alias("item_id"), F.col("similarity").cast("double"))
             .where(F.col("similarity") != 0).dropna()
             .withColumn("_level", F.when(top > 0, F.floor(F.log2(top))).otherwise(F.lit(0)).cast("int")))
    cells = stored(cells, "columns")
    if seen is not None:
        seen = seen.select("user_id", "item_id").dropna().distinct()
        seen = stored(seen.join(a.select("user_id").distinct(), "user_id", "left_semi"), "seen")
    parts = cells.groupBy("_level").agg(F.ceil(F.count("*") / block_cells).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("item_id"), F.col("_parts")).cast("int")
    # a double has some 2,100 powers of two, so there are no more levels
    placed = cells.join(F.broadcast(parts), "_level").withColumn("_part", part).drop("_parts")
    size = a.agg(F.count("*").alias("n"), F.min("affinity").alias("low")).first()
    blocks = max(1, -(-size["n"] // user_cells))
    lowest = cells.agg(F.min("similarity").alias("low")).first()["low"]

    largest = stored(placed.groupBy("_via", "_level", "_part").agg(F.max("similarity").alias("_top")), "largest")
    steps = fan_out_join(a, largest, ["_via"], ["user_id"])
    if min(size["low"] or 0.0, lowest or 0.0) >= 0:
        bound = F.sum(F.col("affinity") * F.col("_top")).over(Window.partitionBy("user_id", "_level", "_part"))
        steps = steps.withColumn("_bound", bound).join(_floors(a, cells, k, seen), "user_id", "left")
        # room for the rounding of sums, and of scores before they are compared
        steps = steps.where(F.col("_bound") * (1 + 1e-9) + 2e-9 >= F.coalesce("_floor", F.lit(0.0)))
    steps = stored(steps.select(F.pmod(F.xxhash64("user_id"), F.lit(blocks)).cast("int").alias("_users"), "_level", "_part",
                                "user_id", "_via", "affinity", F.lit(False).alias("_seen")), "steps")
    met = steps.select(F.col("_users").alias("_for"), "_level", "_part").distinct()
    right = fan_out_join(placed, met, ["_level", "_part"], ["item_id"]).select(
        "_for", F.col("_level").alias("_at"), F.col("_part").alias("_in"), "_via", "item_id", "similarity")
    left = steps
    if seen is not None:
        where = placed.select("item_id", "_level", "_part").distinct()
        own = steps.select(*BLOCK, "user_id").distinct()
        left = left.unionByName(seen.join(where, "item_id").join(own, ["user_id", "_level", "_part"]).select(
            *BLOCK, "user_id", F.col("item_id").alias("_via"), F.lit(0.0).alias("affinity"), F.lit(True).alias("_seen")))
    kinds = {f.name: f.dataType.simpleString() for f in [*a.schema, *cells.schema]}
    found = left.groupBy(*BLOCK).cogroup(right.groupBy("_for", "_at", "_in")).applyInArrow(
        _solver(k), f"user_id {kinds['user_id']}, item_id {kinds['item_id']}, score double")
    return top_k(found, ["user_id"], [F.desc(settled(F.col("score"))), F.asc("item_id")], k).drop("rank")


def score_stats(a: DataFrame, s: DataFrame, item_count: int) -> DataFrame:
    """(user_id, mean_score, max_score) over all items, unscored ones counting as 0.

    A row of Y sums to the affinities times the row sums of S; the largest score is the best of one.
    """
    a = stored(a.select("user_id", "item_id", "affinity"), "rows")
    s = stored(s.select("item_id", "other_id", "similarity"), "similarity")
    sums = s.groupBy("item_id").agg(F.sum("similarity").alias("_sum"))
    mean = (a.join(sums, "item_id").groupBy("user_id")
            .agg((F.sum(F.col("affinity") * F.col("_sum")) / F.lit(item_count)).alias("mean_score")))
    best = best_scores(a, s, 1).select("user_id", F.col("score").alias("_best"))
    return mean.join(best, "user_id", "left").select(
        "user_id", "mean_score", F.greatest(F.coalesce("_best", F.lit(0.0)), F.lit(0.0)).alias("max_score"))
