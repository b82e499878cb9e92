"""Matrix factorisation with MLlib: training, recommendations, similar items."""

from __future__ import annotations

import math

from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.operators.catalogue import append_index
from covista.operators.vectors import similar_by_distance
from covista.plans import WORK_ROWS, best_products, fan_out_join, key_counts, shared_dir, spread, stored, top_k
from covista.sources.tables import latest_interactions

INT_MAX = 2**31 - 1
CHECKPOINT_EVERY = 10
# users of an item, and rows of a task, whose lists are added up where the item lies
CROWD, ROWS_OF_TASK = 10_000, 4_000_000


def fits_int(df: DataFrame, column: str) -> bool:
    """MLlib takes ids of 32 bits only."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return low is None or (low >= -INT_MAX - 1 and high <= INT_MAX)


def with_int_ids(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(df with the column numbered densely, index(id, idx) to map back)."""
    none = df.sparkSession.createDataFrame([], "id long, idx long")
    index = append_index(none, df.select(F.col(column).alias("id")))
    numbered = (df.join(index.withColumnRenamed("id", column), column)
                .drop(column).withColumn(column, F.col("idx").cast("int")).drop("idx"))
    return numbered, index


def _numbered(df: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Ids that MLlib can take, and for each column that had to be numbered the index (id, idx)."""
    indexes = {}
    for column in ("user_id", "item_id"):
        if not fits_int(df, column):
            df, index = with_int_ids(df, column)
            indexes[column] = stored(index, f"{column}-index")
    return df, indexes


def indexes_of(model: ALSModel) -> dict[str, DataFrame]:
    """The indexes of the columns that training numbered; none if all ids fit 32 bits."""
    return getattr(model, "id_indexes", {})


def _own_ids(df: DataFrame, model: ALSModel, **columns: str) -> DataFrame:
    """Numbers back to ids. ``columns``: column of ``df`` = the training column it stands for."""
    for column, source in columns.items():
        if index := indexes_of(model).get(source):
            df = (df.withColumnRenamed(column, "_n").join(index.select(F.col("id").alias(column), F.col("idx").alias("_i")),
                                                          F.col("_n") == F.col("_i")).drop("_n", "_i").select(df.columns))
    return df


def _numbers(ids: DataFrame, model: ALSModel, column: str) -> DataFrame:
    """Distinct ids as the model's numbers."""
    ids = ids.select(column).distinct()
    if index := indexes_of(model).get(column):
        ids = ids.join(index, ids[column] == index["id"]).select(F.col("idx").cast("int").alias(column))
    return ids


def user_factors(model: ALSModel) -> DataFrame:
    """(id, features) of the users, by their own ids."""
    return _own_ids(model.userFactors, model, id="user_id")


def item_factors(model: ALSModel) -> DataFrame:
    return _own_ids(model.itemFactors, model, id="item_id")


def _als(df: DataFrame, rating: str, checkpointInterval: int = CHECKPOINT_EVERY, **params) -> ALS:
    shared_dir(df.sparkSession)  # long fits cut their lineage in the shared folder
    return ALS(userCol="user_id", itemCol="item_id", ratingCol=rating, checkpointInterval=checkpointInterval, **params)


def _fit(rows: DataFrame, rating: str, **params) -> ALSModel:
    rows, indexes = _numbered(rows)
    model = _als(rows, rating, **params).fit(rows)
    model.id_indexes = indexes
    return model


def train_implicit(df: DataFrame, batch_size: int | None = None, max_iter: int = 5, rank: int = 50,
                   reg: float = 0.01, merge: bool = False, seed: int | None = None,
                   ties=("user_id", "item_id")) -> ALSModel:
    """ALS on views, each event one observation of value 1; optionally the newest events only.

    ``merge=True`` feeds one observation per (user, item) with the view count instead. It
    gives another model, and bounds the rows of one user by the number of items.
    """
    if batch_size is not None:
        df = latest_interactions(df, batch_size, ties)
    if merge:
        rows = df.groupBy("user_id", "item_id").agg(F.count("*").cast("float").alias("view"))
    else:
        rows = df.select("user_id", "item_id", F.lit(1.0).cast("float").alias("view"))
    extra = {} if seed is None else {"seed": seed}
    # a checkpoint of the item factors, which are held anyway, lets MLlib delete the users' factors sent in that iteration
    return _fit(rows, "view", checkpointInterval=1, implicitPrefs=True, maxIter=max_iter, rank=rank, regParam=reg, **extra)


def train_explicit(ratings: DataFrame, rank: int = 20, reg: float = 0.02, seed: int = 54, max_iter: int = 10) -> ALSModel:
    # stored: the check of the ids and the fit read them four times, which would join and add them up again each time
    rows = stored(ratings.select("user_id", "item_id", F.col("rating").cast("float").alias("rating")), "ratings")
    return _fit(rows, "rating", rank=rank, regParam=reg, seed=seed, maxIter=max_iter)


def _lists(model: ALSModel, seeds: DataFrame, items: DataFrame, n: int, key: str, other: str) -> DataFrame:
    """(key, other, rating, rank): MLlib's lists by block products, as its own loop over all pairs takes some ten times as long."""
    def vectors(factors):
        return factors.select("id", F.col("features").alias("vector"))

    found = best_products(vectors(seeds), vectors(items), n).select(
        F.col("seed_id").cast("int").alias(key), F.col("item_id").cast("int").alias(other), F.col("score").cast("float").alias("rating"), "rank")
    return _own_ids(found, model, user_id="user_id", item_id="item_id")


def _some(factors: DataFrame, ids: DataFrame, model: ALSModel, column: str) -> DataFrame:
    return factors.join(_numbers(ids, model, column).withColumnRenamed(column, "id"), "id", "left_semi")


def items_for_all_users(model: ALSModel, n: int = 20) -> DataFrame:
    """(user_id, item_id, rating, rank)"""
    return _lists(model, model.userFactors, model.itemFactors, n, "user_id", "item_id")


def users_for_all_items(model: ALSModel, n: int = 10) -> DataFrame:
    """(item_id, user_id, rating, rank)"""
    return _lists(model, model.itemFactors, model.userFactors, n, "item_id", "user_id")


def items_for_some_users(model: ALSModel, users: DataFrame, n: int) -> DataFrame:
    return _lists(model, _some(model.userFactors, users, model, "user_id"), model.itemFactors, n, "user_id", "item_id")


def users_for_some_items(model: ALSModel, items: DataFrame, n: int) -> DataFrame:
    return _lists(model, _some(model.itemFactors, items, model, "item_id"), model.userFactors, n, "item_id", "user_id")


def similar_by_factors(model: ALSModel, n: int, seeds: DataFrame | None = None, **tuning) -> DataFrame:
    """Nearest items by factor distance, for all items in one job."""
    items = item_factors(model).select(F.col("id").alias("item_id"), F.col("features").alias("vector"))
    if seeds is not None:
        seeds = items.join(seeds.select("item_id").distinct(), "item_id", "left_semi")
    return similar_by_distance(items, n, seeds, **tuning)


def clusters(items: DataFrame, k: int = 5, seed: int = 1):
    """(clustered items(item_id, cluster), fitted model) of ``items(item_id, vector)``."""
    rows = items.select("item_id", array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    model = BisectingKMeans(k=k, seed=seed).fit(rows)
    return model.transform(rows).select("item_id", F.col("prediction").alias("cluster")), model


def cluster_centres(model, spark) -> DataFrame:
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]  # k rows
    return spark.createDataFrame(rows, "cluster int, centre array<double>")


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(F.count("*").alias("items"))


def cluster_mates(clustered: DataFrame, seeds: DataFrame) -> DataFrame:
    """(item_id, other_id): all items in the cluster of each given seed. For a few seeds: the
    result has a whole cluster per seed."""
    wanted = seeds.select("item_id").distinct().join(clustered, "item_id")
    mates = clustered.select(F.col("item_id").alias("other_id"), "cluster")
    return fan_out_join(mates, wanted, ["cluster"], ["other_id"]).select("item_id", "other_id")


def first_cluster_mates(clustered: DataFrame, n: int) -> DataFrame:
    """(item_id, rank, other_id): the n lowest ids that share each item's cluster.

    Only the first n + 1 members of a cluster can appear, so no pairs of members are built.
    """
    heads = (top_k(clustered, ["cluster"], [F.asc("item_id")], n + 1, rank="_p")
             .groupBy("cluster").agg(F.array_sort(F.collect_list("item_id")).alias("heads")))
    others = F.slice(F.filter("heads", lambda i: i != F.col("item_id")), 1, n)
    return (clustered.join(heads, "cluster").select("item_id", F.posexplode(others).alias("p", "other_id"))
            .select("item_id", (F.col("p") + 1).alias("rank"), "other_id"))


def two_hop(users_of_items: DataFrame, items_of_users: DataFrame, work_rows: int = WORK_ROWS) -> DataFrame:
    """(item_id, other_id, score): for every seed item, sum over its best users of user score
    times the users' item scores. Both frames are read more than once.

    ``users_of_items(item_id, user_id, rating)``, ``items_of_users(user_id, item_id, rating)``.
    """
    left = users_of_items.select("item_id", "user_id", F.col("rating").cast("double").alias("_v"))
    right = items_of_users.select("user_id", F.col("item_id").alias("other_id"), F.col("rating").cast("double").alias("_s"))
    counts = stored(key_counts(left, right, ["user_id"]), "hop-counts")
    made = counts.agg(F.max(F.col("_l") * F.col("_r").cast("double")), F.sum(F.col("_l") * F.col("_r").cast("double"))).first()
    crowd = left.groupBy("item_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if (made[0] or 0) > work_rows or crowd > CROWD:
        # rows are added up before they move, so that neither such a user nor such an item is one task's
        return (fan_out_join(left, right, ["user_id"], ["item_id"], work_rows)
                .groupBy("item_id", "other_id").agg(F.sum(F.col("_v") * F.col("_s")).alias("score")))
    # a user's items come to an item as one list, not as rows, and are added up there
    lists = (right.join(counts.select("user_id"), "user_id", "left_semi").groupBy("user_id")
             .agg(F.collect_list(F.struct("other_id", "_s")).alias("_e"))
             .select("user_id", F.col("_e.other_id").alias("other_id"), F.col("_e._s").alias("_s")))
    tasks = max(spread(left), math.ceil((made[1] or 0) / ROWS_OF_TASK))
    met = left.join(lists, "user_id").select("item_id", "_v", "other_id", "_s").repartition(tasks, "item_id")
    return (met.select("item_id", "_v", F.explode(F.arrays_zip("other_id", "_s")).alias("_e"))
            .groupBy("item_id", F.col("_e.other_id").alias("other_id")).agg(F.sum(F.col("_v") * F.col("_e._s")).alias("score")))


def similar_by_two_hops(model: ALSModel, n_users: int = 10, n_items: int = 100, seeds: DataFrame | None = None) -> DataFrame:
    if seeds is None:
        first = users_for_all_items(model, n_users)
    else:
        first = users_for_some_items(model, seeds, n_users)
    first = stored(first, "first-hop")
    return two_hop(first, stored(items_for_some_users(model, first.select("user_id"), n_items), "second-hop"))
