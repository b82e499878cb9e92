"""The supplied tables under the names the recommenders use."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covista.operators.counts import distinct_pairs
from covista.plans import scratch_path, stored
from covista.sources import interactions, read_table

ALPHA = 0.6
HALF_LIFE = 7 * 86400.0
# part types that carry no metadata, to exercise ids that metadata does not know
BARE_TYPE = "PROMO"
INDEX_START = "1997-01-01"


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        # naive event times are UTC
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, "parquet", f"{self.folder}/{name}.parquet")

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    @property
    def views(self) -> DataFrame:
        """View events; the item is the number in the JSON properties."""
        rows = self.read("events").where(F.col("event_type") == "view")
        item = F.get_json_object("props", "$.k")
        return interactions(rows, "user_id", item, "ts", keep=["event_id"])

    @property
    def purchases(self) -> DataFrame:
        """Order lines as interactions, the quantity as rating."""
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
        rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        return interactions(rows, "o_custkey", "l_partkey", "o_orderdate", keep=[
            F.col("l_quantity").alias("rating"), "l_orderkey", "l_linenumber"])

    @cached_property
    def view_pairs(self) -> DataFrame:
        return stored(distinct_pairs(self.views), "view-pairs")

    @cached_property
    def purchase_pairs(self) -> DataFrame:
        return stored(distinct_pairs(self.purchases), "purchase-pairs")

    @property
    def raw_movies(self) -> DataFrame:
        """Parts as a raw catalogue: "name (year)", some without a year, some starting with it."""
        year = (1950 + F.col("p_size")).cast("string")
        title = (F.when(F.col("p_type") == "STANDARD", F.col("p_name"))
                 .when(F.col("p_type") == "LARGE", F.concat(F.lit("("), year, F.lit(") "), "p_name"))
                 .otherwise(F.concat("p_name", F.lit(" ("), year, F.lit(")"))))
        return self.read("part").select(F.col("p_partkey").alias("movieId"), title.alias("title"),
                                        F.concat_ws("|", "p_type", "p_brand").alias("genres"))

    @property
    def links(self) -> DataFrame:
        """A link id for every part that was ever ordered."""
        return (self.read("lineitem").groupBy(F.col("l_partkey").alias("movieId"))
                .agg(F.min("l_suppkey").alias("tmdbId")))

    @property
    def metadata(self) -> DataFrame:
        """(item_id, title, filters) of the parts that have metadata."""
        return (self.read("part").where(F.col("p_type") != BARE_TYPE)
                .select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
                        F.array("p_type", "p_brand").alias("filters")))

    @property
    def vectors(self) -> DataFrame:
        return self.read("embeddings").select(F.col("vec_id").alias("item_id"),
                                              F.col("embedding").cast("array<double>").alias("vector"))

    @property
    def described_vectors(self) -> DataFrame:
        parts = self.read("part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
                                         F.array(F.lower("p_type"), F.lower("p_brand")).alias("genres"),
                                         (1950 + F.col("p_size")).alias("year"))
        return self.vectors.join(parts, "item_id", "left")


# The same tables in SQL.
VIEWS = """views AS (
  SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS item_id, ts AS event_time, event_id
  FROM events WHERE event_type = 'view')"""
PURCHASES = """purchases AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, o_orderdate AS event_time, l_quantity AS rating,
         l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
RAW_MOVIES = """raw_movies AS (
  SELECT p_partkey AS movieId,
         CASE WHEN p_type = 'STANDARD' THEN p_name
              WHEN p_type = 'LARGE' THEN '(' || (1950 + p_size) || ') ' || p_name
              ELSE p_name || ' (' || (1950 + p_size) || ')' END AS title,
         p_type || '|' || p_brand AS genres
  FROM part)"""
METADATA = f"""metadata AS (
  SELECT p_partkey AS item_id, p_name AS title, p_type, p_brand FROM part WHERE p_type <> '{BARE_TYPE}')"""
VECTORS = "vecs AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings)"
VIEW_PAIRS = "pairs AS (SELECT DISTINCT user_id, item_id FROM views)"
PURCHASE_PAIRS = "pairs AS (SELECT DISTINCT user_id, item_id FROM purchases)"
CELLS = """cells AS (
  SELECT a.item_id, b.item_id AS other_id, count(*) AS n
  FROM pairs a JOIN pairs b ON a.user_id = b.user_id GROUP BY 1, 2)"""
OWN = "own AS (SELECT item_id, count(*) AS viewers FROM pairs GROUP BY 1)"


def affinity_sql(source: str = "views", half_life: float = HALF_LIFE) -> str:
    return f"""affinity AS (
  SELECT user_id, item_id,
         sum(pow(2.0, -((SELECT epoch(max(event_time)) FROM {source}) - epoch(event_time)) / {half_life})) AS a
  FROM {source} GROUP BY 1, 2)"""


SCORES = """scores AS (
  SELECT a.user_id, c.other_id AS item_id, sum(a.a * c.n) AS score
  FROM affinity a JOIN cells c ON a.item_id = c.item_id GROUP BY 1, 2)"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
