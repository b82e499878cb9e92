"""Reading, shaping and writing interaction, catalogue and index tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covista.plans import first_rows, stored

INTERACTION = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("event_time", T.TimestampType()),
])
RATED = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts_ms", T.LongType()),
])
# Column names of the rating, movie and link files (fixed by the public data format).
RATINGS_CSV = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])
MOVIES_CSV = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])
LINKS_CSV = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("imdbId", T.StringType()),
    T.StructField("tmdbId", T.LongType()),
])
ID_INDEX = T.StructType([T.StructField("id", T.LongType()), T.StructField("idx", T.LongType())])


# --- read ---------------------------------------------------------------

TABLE_PREFIX = "version_"


def read_table(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """Any Spark data source: a table store by options, or files by path."""
    return spark.read.format(fmt).options(**options).load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred in an extra pass."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def interactions(df: DataFrame, user: str | Column, item: str | Column, time: str | Column,
                 keep: Sequence[str] = ()) -> DataFrame:
    """(user_id, item_id, event_time, *keep) from a table with other names."""
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    return df.select(col(user).cast("long").alias("user_id"), col(item).cast("long").alias("item_id"),
                     col(time).cast("timestamp").alias("event_time"), *keep)


def latest_interactions(df: DataFrame, n: int, ties: Sequence[str] = ("user_id", "item_id")) -> DataFrame:
    """The newest n events."""
    return first_rows(df, "event_time", n, list(ties))


def slices(df: DataFrame, lengths: Sequence[int], ties: Sequence[str] = ("user_id", "item_id"),
           time: str = "event_time") -> dict[int, DataFrame]:
    """The oldest n rows for every n, as growing data sets for timing.

    Each slice starts the next longer one, so the longest is read from the source and stored.
    """
    longest = stored(first_rows(df, time, max(lengths), list(ties), newest=False), "longest-slice")
    return {n: longest.orderBy(time, *ties).limit(n) for n in lengths}


def id_frame(spark: SparkSession, ids: Sequence[int], name: str) -> DataFrame:
    """One-column frame from a short list of ids given by a caller."""
    return spark.createDataFrame([(int(i),) for i in ids], T.StructType([T.StructField(name, T.LongType())]))


def reuse(df: DataFrame) -> DataFrame:
    """Keep a frame that several jobs read; call unpersist() on it afterwards."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def profile(df: DataFrame) -> DataFrame:
    """One row: events, users, items, first and last event time.

    Users and items are counted each by a grouping of its own; counting both in one aggregation
    would send every row three times.
    """
    by_user = df.groupBy("user_id").agg(F.count("*").alias("n"), F.min("event_time").alias("a"), F.max("event_time").alias("z"))
    items = df.groupBy("item_id").agg(F.lit(1).alias("one")).agg(F.count("item_id").alias("items"))
    return by_user.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("events"), F.count("user_id").alias("users"),
                       items.scalar().alias("items"), F.min("a").alias("first_event"), F.max("z").alias("last_event"))


# --- write --------------------------------------------------------------

def one_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The last row of every key, as a keyed write would leave it.

    ``max_by`` merges on the map side, so a key with very many versions is no hot task.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*newest_by)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def latest_by_key(new: DataFrame, key: str, newest_by: Sequence[str] | None = None) -> DataFrame:
    """One row per id: the last by ``newest_by``, by all other columns if not given."""
    rest = [c for c in new.columns if c != key]
    return one_per_key(new, [key], newest_by or rest) if rest else new.distinct()


def update_rows(old: DataFrame, new: DataFrame, key: str, newest_by: Sequence[str] | None = None) -> DataFrame:
    """Partial update: fields of ``new`` replace or extend those of ``old``; ids that only
    ``new`` has are left out, ids that only ``old`` has stay. Of several rows of an id in ``new``
    the last by ``newest_by`` counts (by all its columns if not given)."""
    new = latest_by_key(new, key, newest_by)
    fresh = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in new.columns if c != key])
    joined = old.join(fresh, key, "left")
    columns = []
    for c in old.columns:
        columns.append(F.coalesce(f"_new_{c}", c).alias(c) if c != key and c in new.columns else F.col(c))
    columns += [F.col(f"_new_{c}").alias(c) for c in new.columns if c not in old.columns]
    return joined.select(*columns)


def index_rows(old: DataFrame, new: DataFrame, key: str, newest_by: Sequence[str] | None = None) -> DataFrame:
    """Whole rows of ``new`` replace or join those of ``old``; one row per id of ``new``, as in
    ``update_rows``."""
    new = latest_by_key(new, key, newest_by)
    return old.join(new, key, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert(spark: SparkSession, root: str, new: DataFrame, key: str, newest_by: Sequence[str] | None = None,
           partial: bool = False, **options) -> str:
    """Write ``new`` into the table kept under ``root`` as numbered versions; gives the new version's path.

    The newest complete version is read and the next one written beside it, so readers never see a
    table half written and nothing is overwritten while it is read. ``partial``: see ``update_rows``.
    """
    versions = complete_versions(spark, root, TABLE_PREFIX, "_SUCCESS")
    number = int(versions[-1].removeprefix(TABLE_PREFIX)) if versions else 0
    if versions:
        old = spark.read.parquet(f"{root.rstrip('/')}/{versions[-1]}")
        rows = update_rows(old, new, key, newest_by) if partial else index_rows(old, new, key, newest_by)
    else:
        rows = latest_by_key(new, key, newest_by)
    path = f"{root.rstrip('/')}/{TABLE_PREFIX}{number + 1:08d}"
    write_table(rows, path, **options)
    return path


def read_newest(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version of an upserted table."""
    versions = complete_versions(spark, root, TABLE_PREFIX, "_SUCCESS")
    if not versions:
        raise FileNotFoundError(f"no table under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{versions[-1]}")


def complete_versions(spark: SparkSession, root: str, prefix: str, marker: str) -> list[str]:
    """Names of the folders under ``root`` that hold the marker, oldest first, on any file system
    Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = []
    if fs.exists(path):
        for entry in fs.listStatus(path):
            child = entry.getPath()
            if child.getName().startswith(prefix) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(child, marker)):
                names.append(child.getName())
    return sorted(names)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by: Sequence[str] = (), **options) -> None:
    writer = df.write.format(fmt).mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_report(source: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: rows in the source and rows in the store."""
    counts = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(
        stored.select(F.lit(0).alias("s"), F.lit(1).alias("t")))
    return counts.agg(F.sum("s").alias("source_rows"), F.sum("t").alias("stored_rows"))


def write_ids(index: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    index.write.format(fmt).mode(mode).save(path)


def read_ids(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType = ID_INDEX) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)
