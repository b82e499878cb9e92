"""The batch jobs a scheduler runs: train, write lists, refresh the ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from covista.operators import affinity, cooccurrence, counts, factors, recommend
from covista.sources import export_factors, load_latest_model, save_model, upsert, write_table

BATCH, POPULAR_BATCH, LIST = 100, 10_000, 20


def train(df: DataFrame, root: str, batch_size: int = BATCH, max_iter: int = 5, rank: int = 50,
          reg: float = 0.01, seed: int | None = None) -> str:
    """Fit on the newest events and save the model under ``root``; gives its path."""
    return save_model(factors.train_implicit(df, batch_size, max_iter, rank, reg, seed=seed), root)


def write_items_for_users(spark: SparkSession, root: str, path: str, n: int = LIST, **options) -> None:
    """(user_id, item_id, rating, rank) of the newest model for all users."""
    write_table(factors.items_for_all_users(load_latest_model(spark, root), n), path, **options)


def write_items_for_items(spark: SparkSession, root: str, path: str, n: int = LIST, **options) -> None:
    """(item_id, rank, other_id, distance, difference) for all items of the newest model, in one job."""
    write_table(factors.similar_by_factors(load_latest_model(spark, root), n), path, **options)


def write_ranking(df: DataFrame, path: str, batch_size: int = BATCH, **options) -> None:
    """(item_id, views, ranking) over the newest events."""
    write_table(counts.update_ranking(df, batch_size), path, **options)


def top_popular(df: DataFrame, n: int = LIST) -> DataFrame:
    return counts.popular(df, n, POPULAR_BATCH)


def write_cold_start(users: DataFrame, df: DataFrame, path: str, n: int = LIST, **options) -> None:
    """The popular list for every user without a history."""
    write_table(counts.cold_start(users, df, n, POPULAR_BATCH), path, **options)


def export_both_factors(ratings: DataFrame, users_root: str, items_root: str, **fit) -> None:
    """Fit on ratings and write the factors of users and items into their tables."""
    model = factors.train_explicit(ratings, **fit)
    for table, root in ((factors.user_factors(model), users_root), (factors.item_factors(model), items_root)):
        upsert(ratings.sparkSession, root, export_factors(table, model.uid), "id")


def fit_similarity(df: DataFrame, root: str, metric: str = "counts") -> None:
    """Count pairs of items once and keep pairs, similarity and affinity under ``root``; lists read them."""
    pairs_root, spark = f"{root.rstrip('/')}/pairs", df.sparkSession
    write_table(counts.distinct_pairs(df), pairs_root, mode="overwrite")
    pairs = spark.read.parquet(pairs_root)
    similarity = cooccurrence.item_similarity(cooccurrence.cooccurrence(pairs), metric, counts.viewers_per_item(pairs))
    write_table(similarity, f"{root.rstrip('/')}/similarity", mode="overwrite")
    write_table(affinity.affinity(df), f"{root.rstrip('/')}/affinity", mode="overwrite")


def write_similar_lists(spark: SparkSession, root: str, path: str, n: int = LIST, **options) -> None:
    """(user_id, rank, item_id, ...) of a kept fit for all its users, filled up with popular items."""
    pairs, similarity, rated = (spark.read.parquet(f"{root.rstrip('/')}/{name}") for name in ("pairs", "similarity", "affinity"))
    scores = affinity.predicted_scores(rated, similarity)
    popular = affinity.score_popularity(rated, similarity)
    write_table(recommend.items_for_users(scores, pairs.select("user_id"), n, popular), path, **options)
