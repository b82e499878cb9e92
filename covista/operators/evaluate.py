"""Hold-out splits, hit ratio, squared miss, correlation and the tuning grid."""

from __future__ import annotations

import itertools
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.functions import scaled_miss, settled
from covista.operators.affinity import score_lookup, user_score_stats
from covista.operators.factors import items_for_some_users
from covista.operators.product import score_stats
from covista.plans import stored
from covista.sources.tables import slices

# Fixed values of the tuning grid.
GRID_LENGTHS = (100, 1000, 5000, 10000, 25000, 50000)
GRID_RANKS = (5, 20, 40, 100)
GRID_ITERATIONS = (3, 5, 10, 15)
GRID_REGS = (0.01,)
# rows of a slice that one block of users, or of items, is solved for
BLOCK_ROWS = 10_000


def random_split(df: DataFrame, test: float = 0.2, seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    train, held = df.randomSplit([1 - test, test], seed)
    return train, held


def key_share(key: Column) -> Column:
    """A number in [0, 1) fixed by the key."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def split_by_key(df: DataFrame, key: str, test: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the row key. Unlike a random split it gives every row the
    same side when a lost task is run again, and it needs no sort."""
    held = key_share(F.col(key)) < test
    return df.where(~held), df.where(held)


def common_pairs(test: DataFrame, recommended: DataFrame) -> DataFrame:
    """Distinct (user, item) pairs in both."""
    return test.select("user_id", "item_id").intersect(recommended.select("user_id", "item_id"))


def hit_ratio(test: DataFrame, recommended: DataFrame) -> DataFrame:
    """One row: hits, test rows, distinct test pairs, hits / rows and hits / pairs."""
    counted = test.groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    hit = recommended.select("user_id", "item_id").distinct().withColumn("_hit", F.lit(1))
    return (counted.join(hit, ["user_id", "item_id"], "left")
            .agg(F.coalesce(F.sum("_hit"), F.lit(0)).cast("long").alias("hits"),
                 F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("test_rows"),
                 F.count("*").alias("test_pairs"))
            .select("*", F.when(F.col("test_rows") > 0, F.col("hits") / F.col("test_rows")).alias("hit_ratio"),
                    F.when(F.col("test_pairs") > 0, F.col("hits") / F.col("test_pairs")).alias("distinct_hit_ratio")))


def squared_miss(test: DataFrame, scores: DataFrame, item_count: Column | int, users: DataFrame,
                 items: DataFrame) -> DataFrame:
    """One row: summed (1 - score/max)^2 over test rows scored below the user's mean, the rows
    that count, and the rows skipped for an unknown user or item.

    ``scores`` need to cover the users of ``test``. Means run over all items.
    """
    scores = stored(scores.select("user_id", "item_id", "score"), "scores")  # read for the means and for the test rows
    return _miss(test, scores, user_score_stats(scores, item_count), users, items)


def squared_miss_of(test: DataFrame, a: DataFrame, s: DataFrame, item_count: int, users: DataFrame, items: DataFrame) -> DataFrame:
    """``squared_miss`` from A and S: the scores of the test rows and each user's statistics, without the matrix Y."""
    a = stored(a.join(test.select("user_id").distinct(), "user_id", "left_semi"), "affinity")
    s = stored(s.select("item_id", "other_id", "similarity"), "similarity")
    return _miss(test, score_lookup(a, s, test), score_stats(a, s, item_count), users, items)


def _miss(test: DataFrame, scores: DataFrame, stats: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    rows = test.groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    rows = (rows.join(users.select("user_id").distinct().withColumn("_u", F.lit(1)), "user_id", "left")
            .join(items.select("item_id").distinct().withColumn("_i", F.lit(1)), "item_id", "left"))
    known = F.col("_u").isNotNull() & F.col("_i").isNotNull()
    score = F.coalesce("score", F.lit(0.0))
    joined = (rows.join(scores, ["user_id", "item_id"], "left")
              .join(stats, "user_id", "left")
              .select("n", known.alias("known"), score.alias("score"),
                      F.coalesce("mean_score", F.lit(0.0)).alias("mean"), F.coalesce("max_score", F.lit(0.0)).alias("top")))
    below = F.col("known") & (settled(F.col("score")) < settled(F.col("mean")))
    miss = scaled_miss(F.col("score"), F.col("top"))

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0))

    return joined.agg(
        total(F.when(below, F.col("n") * miss)).cast("double").alias("error"),
        total(F.when(below, F.col("n"))).cast("long").alias("counted"),
        total(F.when(~F.col("known"), F.col("n"))).cast("long").alias("skipped"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(left, right, pearson) for every pair of columns, in one pass."""
    pairs = list(itertools.product(columns, columns))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"c{i}").alias("pearson"))
                      for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(cells))


def tuning_grid(df: DataFrame, lengths: Sequence[int] = GRID_LENGTHS, ranks: Sequence[int] = GRID_RANKS,
                iterations: Sequence[int] = GRID_ITERATIONS, regs: Sequence[float] = GRID_REGS, ties=("user_id", "item_id"),
                together: int = 1) -> DataFrame:
    """(rank, max_iter, reg_param, length, train_times): seconds per fit over growing slices.

    Users and items are solved in as many blocks as a slice has ``BLOCK_ROWS`` rows: each iteration is two stages of that
    many tasks, and for short slices more of them only wait for each other. ``together`` fits of a slice run at a
    time, each in a scheduler pool of its own; their times then include what they take from each other. The loop runs
    over parameter settings only; every fit is a Spark job.
    """
    spark, results = df.sparkSession, []
    for length, part in slices(df, lengths, ties).items():
        rows = part.select("user_id", "item_id", F.lit(1.0).cast("float").alias("view")).persist()
        blocks = max(1, -(-rows.count() // BLOCK_ROWS))
        rows = rows.coalesce(blocks)

        def seconds(setting, rows=rows, blocks=blocks):
            rank, max_iter, reg = setting
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"grid-{rank}-{max_iter}-{reg}")
            als = ALS(userCol="user_id", itemCol="item_id", ratingCol="view", implicitPrefs=True, rank=rank, maxIter=max_iter,
                      regParam=reg, numUserBlocks=blocks, numItemBlocks=blocks)
            start = time.perf_counter()
            als.fit(rows)
            return rank, max_iter, float(reg), int(length), time.perf_counter() - start

        with ThreadPoolExecutor(together) as pool:
            settings = sorted(itertools.product(ranks, iterations, regs), key=lambda s: -s[0] * s[1])  # the longest first
            results += [f.result() for f in [pool.submit(inheritable_thread_target(spark)(seconds), s) for s in settings]]
        rows.unpersist()
    return spark.createDataFrame(results, "rank int, max_iter int, reg_param double, length long, train_times double")


def evaluate_model(model, train: DataFrame, test: DataFrame, n: int = 100) -> DataFrame:
    """Hit ratio of the model's n items per user, for users in both train and test."""
    users = train.join(test.select("user_id").distinct(), "user_id", "left_semi").select("user_id").distinct()
    return hit_ratio(test, items_for_some_users(model, users, n))
