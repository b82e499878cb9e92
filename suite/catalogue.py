"""Sources, sinks, cleaning, filters and id indexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from covista.functions import (
    epoch_millis,
    first_nested,
    has_any_term,
    has_genre,
    implicit_rating,
    in_range,
    lacks_terms,
    stamp,
)
from covista.operators import catalogue as ops
from covista.operators.counts import popular
from covista.sources import (
    LINKS_CSV,
    MOVIES_CSV,
    RATINGS_CSV,
    index_rows,
    latest_interactions,
    one_per_key,
    profile,
    read_buckets,
    read_csv,
    read_ids,
    read_table,
    slices,
    update_rows,
    upsert_buckets,
    write_ids,
    write_report,
    write_table,
)
from suite.registry import query
from suite.tables import (
    BARE_TYPE,
    INDEX_START,
    METADATA,
    PURCHASES,
    RAW_MOVIES,
    VECTORS,
    VIEWS,
    Tables,
    with_sql,
)

LENGTHS = (100, 1000, 5000, 10000, 25000, 50000)
ORDER_KEYS = ("user_id", "item_id", "l_orderkey", "l_linenumber")


@query(with_sql(VIEWS) + """
SELECT user_id, item_id, event_id, epoch_us(event_time) AS event_us FROM views""")
def interaction_scan(t: Tables):
    return t.views.select("user_id", "item_id", "event_id", F.unix_micros("event_time").alias("event_us"))


@query(with_sql(VIEWS) + """
SELECT user_id, item_id, event_id, epoch_us(event_time) AS event_us
FROM views ORDER BY event_time DESC, event_id LIMIT 1000""")
def newest_interactions(t: Tables):
    return latest_interactions(t.views, 1000, ["event_id"]).select(
        "user_id", "item_id", "event_id", F.unix_micros("event_time").alias("event_us"))


@query(with_sql(PURCHASES, """numbered AS (
  SELECT *, row_number() OVER (ORDER BY event_time, user_id, item_id, l_orderkey, l_linenumber) AS rn FROM purchases)""",
                f"sizes AS (SELECT unnest([{', '.join(map(str, LENGTHS))}]) AS length)") + """
SELECT CAST(length AS BIGINT) AS length, count(*) AS n_rows, count(DISTINCT user_id) AS users,
       count(DISTINCT item_id) AS items
FROM numbered JOIN sizes ON rn <= length GROUP BY 1""")
def growing_slices(t: Tables):
    out = None
    for length, part in slices(t.purchases, LENGTHS, ORDER_KEYS).items():
        row = part.agg(F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("users"),
                       F.countDistinct("item_id").alias("items")).withColumn("length", F.lit(length).cast("long"))
        out = row if out is None else out.unionByName(row)
    return out


@query(with_sql(PURCHASES) + """
SELECT user_id AS userId, item_id AS movieId, rating, CAST(epoch(event_time) AS BIGINT) * 1000 AS timestamp
FROM purchases""")
def csv_ratings(t: Tables):
    path = t.scratch("ratings")
    rows = t.purchases.select(F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"), "rating",
                              F.unix_timestamp("event_time").alias("timestamp"))
    write_table(rows, path, "csv", header=True)
    ratings = read_csv(t.spark, path, RATINGS_CSV)
    return ratings.withColumn("timestamp", epoch_millis(F.col("timestamp")))


CLEAN = """
  movieId,
  CASE WHEN regexp_matches(title, '\\(\\d{4}\\)')
       THEN left(title, greatest(instr(title, regexp_extract(title, '\\(\\d{4}\\)')) - 2, 0)) ELSE title END AS title,
  CASE WHEN regexp_matches(title, '\\(\\d{4}\\)')
       THEN substr(regexp_extract(title, '\\(\\d{4}\\)'), 2, 4) ELSE '1970' END AS release_date,
  replace(lower(genres), '|', '/') AS genres"""


@query(with_sql(RAW_MOVIES) + f"SELECT {CLEAN} FROM raw_movies")
def clean_catalogue(t: Tables):
    path = t.scratch("movies")
    write_table(t.raw_movies, path, "csv", header=True)
    movies = ops.clean_movies(read_csv(t.spark, path, MOVIES_CSV))
    return movies.withColumn("genres", F.array_join("genres", "/"))


@query(with_sql(RAW_MOVIES, "links AS (SELECT l_partkey, min(l_suppkey) AS tmdbId FROM lineitem GROUP BY 1)") + f"""
SELECT {CLEAN}, tmdbId FROM raw_movies JOIN links ON movieId = l_partkey""")
def linked_catalogue(t: Tables):
    path = t.scratch("links")
    links = t.links.select("movieId", F.lit(None).cast("string").alias("imdbId"), "tmdbId")
    write_table(links, path, "csv", header=True)
    movies = ops.clean_movies(t.raw_movies, read_csv(t.spark, path, LINKS_CSV))
    return movies.withColumn("genres", F.array_join("genres", "/"))


@query(with_sql(PURCHASES) + "SELECT count(*) AS source_rows, count(*) AS stored_rows FROM purchases")
def written_and_verified(t: Tables):
    rows = t.purchases
    path = t.scratch("stored")
    write_table(rows, path)
    return write_report(rows, read_table(t.spark, "parquet", path))


@query(with_sql(PURCHASES, """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id
                               ORDER BY event_time DESC, l_orderkey DESC, l_linenumber DESC, rating DESC) AS rn
  FROM purchases)""") + """
SELECT user_id, item_id, rating, l_orderkey, l_linenumber FROM numbered WHERE rn = 1""")
def keyed_ratings(t: Tables):
    path = t.scratch("keyed")
    rows = one_per_key(t.purchases, ["user_id", "item_id"], ["event_time", "l_orderkey", "l_linenumber", "rating"])
    write_table(rows.drop("event_time"), path)
    return read_table(t.spark, "parquet", path)


@query(with_sql(VECTORS) + """
SELECT p_partkey AS item_id, p_name AS title, CAST(len(vector) AS BIGINT) AS factors,
       round(list_sum(vector), 6) AS factor_sum, CASE WHEN item_id IS NOT NULL THEN 'v1' END AS model_version
FROM part LEFT JOIN vecs ON item_id = p_partkey""")
def factor_update(t: Tables):
    stored = t.read("part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    fresh = t.vectors.select("item_id", F.col("vector").alias("model_factor"), F.lit("v1").alias("model_version"))
    total = F.aggregate("model_factor", F.lit(0.0), lambda a, v: a + v)
    return update_rows(stored, fresh, "item_id").select(
        "item_id", "title", F.when(F.col("model_factor").isNotNull(), F.size("model_factor")).cast("long").alias("factors"),
        F.round(total, 6).alias("factor_sum"), "model_version")


@query("""WITH fresh AS (SELECT l_partkey AS item_id, max(l_extendedprice) AS price FROM lineitem
                         WHERE l_returnflag = 'R' GROUP BY 1)
SELECT item_id, price, 'lines' AS source FROM fresh
UNION ALL SELECT p_partkey, p_retailprice, 'list' FROM part WHERE p_partkey NOT IN (SELECT item_id FROM fresh)""")
def replaced_rows(t: Tables):
    stored = t.read("part").select(F.col("p_partkey").alias("item_id"), F.col("p_retailprice").alias("price"),
                                   F.lit("list").alias("source"))
    fresh = (t.read("lineitem").where(F.col("l_returnflag") == "R").groupBy(F.col("l_partkey").alias("item_id"))
             .agg(F.max("l_extendedprice").alias("price")).withColumn("source", F.lit("lines")))
    return index_rows(stored, fresh, "item_id")


@query("""WITH fresh AS (SELECT l_partkey AS item_id, max(l_extendedprice) AS price FROM lineitem
                         WHERE l_returnflag = 'R' AND l_quantity >= 49 GROUP BY 1),
rows AS (SELECT item_id, price, 'lines' AS source FROM fresh
         UNION ALL SELECT p_partkey, p_retailprice, 'list' FROM part WHERE p_partkey NOT IN (SELECT item_id FROM fresh))
SELECT rows.item_id, price, source, CAST(len(embedding) AS BIGINT) AS factors
FROM rows LEFT JOIN embeddings ON vec_id = rows.item_id AND vec_id < 50""")
def upserted_buckets(t: Tables):
    """A bucketed table written, partly replaced, partly updated with a new column, and read back."""
    root = t.scratch("buckets")
    listed = t.read("part").select(F.col("p_partkey").alias("item_id"), F.col("p_retailprice").alias("price"),
                                   F.lit("list").alias("source"))
    fresh = (t.read("lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49))
             .groupBy(F.col("l_partkey").alias("item_id")).agg(F.max("l_extendedprice").alias("price"))
             .withColumn("source", F.lit("lines")))
    factors = (t.read("embeddings").where(F.col("vec_id") < 50)
               .select(F.col("vec_id").alias("item_id"), F.size("embedding").cast("long").alias("factors")))
    upsert_buckets(t.spark, root, listed, "item_id")
    upsert_buckets(t.spark, root, fresh, "item_id")
    upsert_buckets(t.spark, root, factors, "item_id", partial=True)
    return read_buckets(t.spark, root)


@query(with_sql(PURCHASES) + """
SELECT count(*) AS events, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
       CAST(epoch(min(event_time)) AS BIGINT) AS first_event, CAST(epoch(max(event_time)) AS BIGINT) AS last_event
FROM purchases""")
def interaction_profile(t: Tables):
    return profile(t.purchases).select("events", "users", "items", F.unix_timestamp("first_event").alias("first_event"),
                                       F.unix_timestamp("last_event").alias("last_event"))


@query(with_sql(VIEWS, METADATA) + """
SELECT i.item_id, title, p_type || ',' || p_brand AS filters
FROM (SELECT DISTINCT item_id FROM views) i LEFT JOIN metadata m ON i.item_id = m.item_id""")
def metadata_of_items(t: Tables):
    return ops.describe(t.views.select("item_id").distinct(), t.metadata).select(
        "item_id", "title", F.array_join("filters", ",").alias("filters"))


@query(with_sql(PURCHASES) + """
SELECT DISTINCT item_id FROM purchases
WHERE item_id NOT IN (SELECT p_partkey FROM part WHERE p_type <> '%s')""" % BARE_TYPE)
def items_without_metadata(t: Tables):
    return ops.without_metadata(t.purchases, t.metadata)


@query(with_sql(VIEWS) + "SELECT user_id, item_id, event_id, 1 AS view FROM views")
def implicit_ratings(t: Tables):
    return t.views.select("user_id", "item_id", "event_id", implicit_rating().alias("view"))


@query("""SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS timestamp,
       strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp FROM orders""")
def order_millis(t: Tables):
    time = F.col("o_orderdate").cast("timestamp")
    return t.read("orders").select("o_orderkey", epoch_millis(time).alias("timestamp"), stamp(time).alias("stamp"))


@query(with_sql(PURCHASES, """best AS (
  SELECT item_id FROM purchases GROUP BY 1 ORDER BY count(*) DESC, item_id LIMIT 1)""") + """
SELECT user_id, item_id, rating FROM purchases WHERE item_id IN (SELECT item_id FROM best)""")
def events_of_top_item(t: Tables):
    rows = t.purchases
    return ops.only_keys(rows, popular(rows, 1), "item_id").select("user_id", "item_id", "rating")


@query(with_sql(PURCHASES) + """
SELECT user_id, item_id, rating FROM purchases
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def events_of_members(t: Tables):
    members = t.read("customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("user_id"))
    return ops.only_keys(t.purchases, members, "user_id").select("user_id", "item_id", "rating")


def _early_index(t: Tables, column: str):
    none = t.spark.createDataFrame([], "id long, idx long")
    early = t.purchases.where(F.col("event_time") < F.lit(INDEX_START).cast("timestamp"))
    return ops.append_index(none, early.select(F.col(column).alias("id")))


EARLY_ITEMS = f"SELECT DISTINCT item_id AS id FROM purchases WHERE event_time < TIMESTAMP '{INDEX_START}'"
EARLY_USERS = f"SELECT DISTINCT user_id AS id FROM purchases WHERE event_time < TIMESTAMP '{INDEX_START}'"


@query(with_sql(PURCHASES) + """
SELECT id, row_number() OVER (ORDER BY id) - 1 AS idx FROM (SELECT DISTINCT user_id AS id FROM purchases)""")
def user_index(t: Tables):
    none = t.spark.createDataFrame([], "id long, idx long")
    path = t.scratch("user-index")
    write_ids(ops.append_index(none, t.purchases.select(F.col("user_id").alias("id"))), path)
    return read_ids(t.spark, path)


@query(with_sql(PURCHASES, f"early AS ({EARLY_ITEMS})", """old AS (
  SELECT id, row_number() OVER (ORDER BY id) - 1 AS idx FROM early)""", """fresh AS (
  SELECT id, row_number() OVER (ORDER BY id) - 1 + (SELECT count(*) FROM early) AS idx
  FROM (SELECT DISTINCT item_id AS id FROM purchases) WHERE id NOT IN (SELECT id FROM early))""") + """
SELECT * FROM old UNION ALL SELECT * FROM fresh""")
def grown_item_index(t: Tables):
    return ops.append_index(_early_index(t, "item_id"), t.purchases.select(F.col("item_id").alias("id")))


@query(with_sql(PURCHASES, f"early AS ({EARLY_USERS})") + """
SELECT DISTINCT user_id AS id FROM purchases WHERE user_id NOT IN (SELECT id FROM early)""")
def new_users(t: Tables):
    return ops.new_ids(t.purchases, _early_index(t, "user_id"), "user_id")


@query(with_sql(PURCHASES, f"early AS ({EARLY_USERS})", "ids AS (SELECT DISTINCT user_id AS id FROM purchases)") + """
SELECT count(*) FILTER (id NOT IN (SELECT id FROM early)) AS new,
       count(*) FILTER (id IN (SELECT id FROM early)) AS ignored FROM ids""")
def user_id_check(t: Tables):
    return ops.id_check(t.purchases, _early_index(t, "user_id"), "user_id")


@query(with_sql(PURCHASES, METADATA, f"early AS ({EARLY_ITEMS})", """fresh AS (
  SELECT DISTINCT item_id AS id FROM purchases WHERE item_id NOT IN (SELECT id FROM early))""", """tally AS (
  SELECT (SELECT count(*) FROM early) AS b,
         (SELECT count(*) FROM fresh WHERE id IN (SELECT item_id FROM metadata)) AS n,
         (SELECT count(*) FROM fresh WHERE id NOT IN (SELECT item_id FROM metadata)) AS o)""") + """
SELECT b AS before, b + n AS after, n AS added, o AS omitted FROM tally""")
def index_growth(t: Tables):
    before = _early_index(t, "item_id")
    after, omitted = ops.grow_item_index(before, t.purchases, t.metadata)
    return ops.index_report(before, after, omitted)


@query(with_sql(PURCHASES, METADATA, f"early AS ({EARLY_USERS})", """used AS (
  SELECT count(*) AS n FROM purchases
  WHERE user_id IN (SELECT id FROM early) AND item_id IN (SELECT item_id FROM metadata))""") + """
SELECT n AS used, (SELECT count(*) FROM purchases) - n AS ignored FROM used""")
def valid_interactions(t: Tables):
    items = t.metadata.select(F.col("item_id").alias("id"))
    return ops.interaction_check(t.purchases, _early_index(t, "user_id"), items)


@query(with_sql(PURCHASES, METADATA) + """
SELECT user_id, item_id, rating FROM purchases WHERE item_id IN (SELECT item_id FROM metadata)""")
def known_item_events(t: Tables):
    items = t.metadata.select(F.col("item_id").alias("id"))
    return ops.known_interactions(t.purchases, items=items).select("user_id", "item_id", "rating")


@query("""SELECT o_orderstatus, count(*) AS n FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31' GROUP BY 1""")
def orders_in_range(t: Tables):
    inside = in_range(F.col("o_orderdate"), F.to_timestamp_ntz(F.lit("1996-01-01")), F.to_timestamp_ntz(F.lit("1997-12-31")))
    return t.read("orders").where(inside).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(with_sql(RAW_MOVIES, f"clean AS (SELECT {CLEAN} FROM raw_movies)") + """
SELECT movieId, title, release_date FROM clean WHERE release_date >= '1980'""")
def titles_since(t: Tables):
    return ops.clean_movies(t.raw_movies).where(in_range(F.col("release_date"), "1980")).select(
        "movieId", "title", "release_date")


TERMS = "string_split_regex(lower(p_name), '[^a-z]+')"


@query(f"SELECT p_partkey, p_name FROM part WHERE list_contains({TERMS}, 'ring') OR list_contains({TERMS}, 'hot')")
def titles_with_any_term(t: Tables):
    return t.read("part").where(has_any_term(F.col("p_name"), "Ring", "hot")).select("p_partkey", "p_name")


@query(f"SELECT p_partkey, p_name FROM part WHERE NOT list_contains({TERMS}, 'ring')")
def titles_without_term(t: Tables):
    return t.read("part").where(lacks_terms(F.col("p_name"), "ring")).select("p_partkey", "p_name")


@query(with_sql(RAW_MOVIES) + "SELECT movieId FROM raw_movies WHERE list_contains(string_split(lower(genres), '|'), 'promo')")
def titles_of_genre(t: Tables):
    return ops.clean_movies(t.raw_movies).where(has_genre(F.col("genres"), "promo")).select("movieId")


@query("""SELECT p_partkey AS item_id, p_name AS title, CASE WHEN p_size <= 40 THEN p_type END AS genre FROM part""")
def first_genre(t: Tables):
    genres = F.array(F.struct(F.col("p_type").alias("name")), F.struct(F.col("p_brand").alias("name")))
    nested = F.when(F.col("p_size") <= 40, genres).otherwise(F.slice(genres, 1, 0))
    return t.read("part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
                                 first_nested(nested, "name").alias("genre"))
