"""Top rows, overall and per key, and dense numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covista.plans.shared import shared_dir
from covista.plans.skew import spread

# Spark keeps only the first k rows of a key before the shuffle up to this k.
PUSHED_LIMIT = 1000


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of every key, numbered from 1.

    Below Spark's group-limit threshold each map task passes on at most k rows per key. For a
    larger k the keys are first cut in parts by row hash, so no task sorts a whole hot key.
    """
    if k > PUSHED_LIMIT:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(spread(df))).alias("_part")
        df = (df.select("*", part)
              .withColumn("_place", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)))
              .where(F.col("_place") <= k).drop("_part", "_place"))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def first_rows(df: DataFrame, time: str, n: int, ties: list[str], newest: bool = True) -> DataFrame:
    """The n newest (or oldest) rows by ``time``, ties by the columns ``ties``. Rows without a
    time come last.

    Rows are counted per day first; the day in which the n-th row falls bounds the second
    scan, so the sort sees about n rows and not one heap of n rows per input partition.
    Days are few (calendar bound), so the running total over them is small.
    """
    day = F.date_trunc("DAY", F.col(time).cast("timestamp"))
    days = df.where(F.col(time).isNotNull()).groupBy(day.alias("day")).agg(F.count("*").alias("rows"))
    running = F.sum("rows").over(Window.orderBy(F.desc("day") if newest else F.asc("day")))
    needed = days.select("day", "rows", running.alias("total")).where(F.col("total") - F.col("rows") < n)
    moment = F.col(time).cast("timestamp")
    if newest:
        inside = moment >= needed.agg(F.min("day").alias("d")).scalar()
        order = F.desc_nulls_last(time)
    else:
        inside = moment < needed.agg((F.max("day") + F.expr("INTERVAL 1 DAY")).alias("d")).scalar()
        order = F.asc_nulls_last(time)
    timed = days.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).scalar()
    return df.where(inside | (F.col(time).isNull() & (timed < n))).orderBy(order, *ties).limit(n)


def as_array(df: DataFrame, column: str, order: list[Column], n: int) -> Column:
    """The first n values of a column as one array, usable as a constant in other frames."""
    place = Window.orderBy(*order)
    rows = df.orderBy(*order).limit(n).select(F.row_number().over(place).alias("p"), F.col(column).alias("v"))
    packed = F.array_sort(F.collect_list(F.struct("p", "v")))
    return rows.agg(F.transform(packed, lambda r: r["v"]).alias("ids")).scalar()


def with_ordinal(df: DataFrame, order: list[str], name: str, start: Column | int = 0) -> DataFrame:
    """Consecutive numbers from ``start`` in the given order, without a single-task window.

    The rows are range-sorted and checkpointed, so that recomputing a lost part cannot move
    rows. Each row's number is its place in its partition plus the sizes of the partitions
    before; there are as many sizes as partitions.
    """
    shared_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumn("_slice", F.shiftright("_at", 33))
    sizes = placed.groupBy("_slice").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    first = start if isinstance(start, Column) else F.lit(start)
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.join(F.broadcast(offsets), "_slice")
            .withColumn(name, (first + F.col("_before") + within).cast("long"))
            .drop("_at", "_slice", "_before"))
