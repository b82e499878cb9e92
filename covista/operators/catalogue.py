"""Catalogue cleaning, id indexes and id checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.functions import clean_year_title, genre_array
from covista.plans import with_ordinal


def clean_movies(movies: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """(movieId, title, release_date, genres[, tmdbId]) from the raw movie and link files."""
    cleaned = clean_year_title(F.col("title"))
    out = movies.select("movieId", cleaned["title"].alias("title"),
                        cleaned["release_date"].alias("release_date"), genre_array(F.col("genres")).alias("genres"))
    return out if links is None else out.join(links.select("movieId", "tmdbId"), "movieId")


def only_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in the key frame."""
    return df.join(keys.select(on).distinct(), on, "left_semi")


def new_ids(df: DataFrame, index: DataFrame, column: str) -> DataFrame:
    """Distinct ids of the batch that the index(id, idx) does not have."""
    return df.select(F.col(column).alias("id")).distinct().join(index, "id", "left_anti")


def id_check(df: DataFrame, index: DataFrame, column: str) -> DataFrame:
    """One row: distinct ids of the batch that are new, and those ignored as already indexed."""
    ids = df.select(F.col(column).alias("id")).distinct()
    marked = ids.join(index.select("id", F.lit(1).alias("_old")), "id", "left")
    return marked.agg((F.count("*") - F.count("_old")).alias("new"), F.count("_old").alias("ignored"))


def append_index(index: DataFrame, ids: DataFrame) -> DataFrame:
    """Index with the new ids numbered on, in id order."""
    start = index.agg(F.coalesce(F.max("idx") + 1, F.lit(0)).alias("n")).scalar()
    fresh = with_ordinal(ids.select("id").distinct().join(index, "id", "left_anti"), ["id"], "idx", start)
    return index.select("id", "idx").unionByName(fresh.select("id", "idx"))


def grow_item_index(index: DataFrame, df: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(grown index, new items without metadata). Items without metadata are not indexed."""
    fresh = new_ids(df, index, "item_id")
    known = metadata.select(F.col("item_id").alias("id"))
    return append_index(index, fresh.join(known, "id", "left_semi")), fresh.join(known, "id", "left_anti")


def index_report(before: DataFrame, after: DataFrame, omitted: DataFrame | None = None) -> DataFrame:
    """One row: index size before and after, ids added, ids left out."""
    flags = before.select(F.lit(1).alias("b"), F.lit(0).alias("a"), F.lit(0).alias("o")).unionAll(
        after.select(F.lit(0), F.lit(1), F.lit(0)))
    if omitted is not None:
        flags = flags.unionAll(omitted.select(F.lit(0), F.lit(0), F.lit(1)))
    return flags.agg(F.sum("b").alias("before"), F.sum("a").alias("after"),
                     (F.sum("a") - F.sum("b")).alias("added"), F.sum("o").alias("omitted"))


def known_interactions(df: DataFrame, users: DataFrame | None = None, items: DataFrame | None = None) -> DataFrame:
    """Events whose user and item are indexed."""
    if users is not None:
        df = df.join(users.select(F.col("id").alias("user_id")), "user_id", "left_semi")
    if items is not None:
        df = df.join(items.select(F.col("id").alias("item_id")), "item_id", "left_semi")
    return df


def interaction_check(df: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """One row: events used and events ignored for an unknown user or item."""
    # users and items are counted first: one row per pair is enough for the lookups
    pairs = df.groupBy("user_id", "item_id").agg(F.count("*").alias("rows"))
    known = known_interactions(pairs, users, items).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).scalar()
    return (pairs.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("events"))
            .select(known.alias("used"), (F.col("events") - known).alias("ignored")))


def describe(rows: DataFrame, metadata: DataFrame, on: str = "item_id") -> DataFrame:
    """Rows with the columns of their metadata; null where there is none."""
    return rows.join(metadata, on, "left")


def without_metadata(rows: DataFrame, metadata: DataFrame, on: str = "item_id") -> DataFrame:
    return rows.select(on).distinct().join(metadata.select(on), on, "left_anti")
