"""Keyed tables in hash buckets, where an upsert rewrites only the buckets its keys fall in.

Under the root lie ``rows/covista_version=V/covista_bucket=B`` with the rows, and ``manifest_V`` with one row per bucket: the
version that holds it, the rows it has and the schema of the table. A version counts once its manifest is whole, so
readers see old or new and an upsert that was lost midway is made again. Old files are referenced, never changed.
One writer at a time. Keys are single and distinct, so their hashes fill the buckets evenly; what the driver
reads has one row per bucket.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covista.sources.tables import complete_versions, index_rows, latest_by_key, update_rows

MANIFEST = "manifest_"
PLACES = "bucket int, version int, row_count long, columns string"
FOLDER = "covista_bucket"
BUCKETS = 64


def _bucket(key: str, buckets: int) -> Column:
    # as text, so that a key has one bucket whether it comes as an int or as a long
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, root: str) -> tuple[int, list]:
    """Number of the newest whole version and its manifest rows, one per bucket."""
    names = complete_versions(spark, root, MANIFEST, "_SUCCESS")
    if not names:
        return 0, []
    rows = spark.read.schema(PLACES).parquet(f"{root}/{names[-1]}").orderBy("bucket").collect()
    return int(names[-1].removeprefix(MANIFEST)), rows


def _rows(spark: SparkSession, root: str, places: Sequence, schema: T.StructType) -> DataFrame:
    paths = [f"{root}/rows/covista_version={p['version']}/covista_bucket={p['bucket']}" for p in places if p["row_count"]]
    if not paths:
        return spark.createDataFrame([], schema)
    # columns that a later partial update brought are null in older files
    return spark.read.schema(schema).option("basePath", f"{root}/rows").parquet(*paths).select(*schema.fieldNames())


def read_buckets(spark: SparkSession, root: str, key: str | None = None, ids: DataFrame | None = None) -> DataFrame:
    """The newest version; with ``ids`` only the rows of those keys, read from their buckets alone."""
    root = root.rstrip("/")
    number, places = _manifest(spark, root)
    if not number:
        raise FileNotFoundError(f"no table under {root}")
    schema = T.StructType.fromJson(json.loads(places[0]["columns"]))
    if ids is None:
        return _rows(spark, root, places, schema)
    wanted = _touched(ids, key, len(places))
    return _rows(spark, root, [p for p in places if p["bucket"] in wanted], schema).join(ids.select(key), key, "left_semi")


def _touched(df: DataFrame, key: str, buckets: int) -> set[int]:
    return {r["bucket"] for r in df.select(_bucket(key, buckets).alias("bucket")).distinct().collect()}


def upsert_buckets(spark: SparkSession, root: str, new: DataFrame, key: str, newest_by: Sequence[str] | None = None,
                   partial: bool = False, buckets: int = BUCKETS) -> int:
    """Write ``new`` into the table under ``root``; gives the new version.

    ``buckets`` counts for a table that does not exist yet: as many as make files of some hundred MB. Whole rows
    are replaced or added (``index_rows``), or with ``partial`` columns of known ids are updated (``update_rows``).
    """
    root = root.rstrip("/")
    number, places = _manifest(spark, root)
    if not places:
        rows, kept, touched = latest_by_key(new, key, newest_by), [], set(range(buckets))
    else:
        buckets = len(places)
        schema = T.StructType.fromJson(json.loads(places[0]["columns"]))
        touched = _touched(new, key, buckets)
        kept = [p for p in places if p["bucket"] not in touched]
        old = _rows(spark, root, [p for p in places if p["bucket"] in touched], schema)
        rows = update_rows(old, new, key, newest_by) if partial else index_rows(old, new, key, newest_by)
    version = number + 1
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    path = f"{root}/rows/covista_version={version}"
    (rows.withColumn(FOLDER, _bucket(key, buckets)).repartition(FOLDER).sortWithinPartitions(FOLDER, key)
     .write.mode("overwrite").partitionBy(FOLDER).parquet(path))
    written = spark.read.schema(f"{FOLDER} int").parquet(path).groupBy(FOLDER).count().collect()  # from file footers
    fresh = {r[FOLDER]: r["count"] for r in written}
    columns = schema.json()
    made = [(p["bucket"], p["version"], p["row_count"], columns) for p in kept]
    made += [(b, version, fresh.get(b, 0), columns) for b in sorted(touched)]
    spark.createDataFrame(made, PLACES).coalesce(1).write.mode("overwrite").parquet(f"{root}/{MANIFEST}{version:08d}")
    return version
