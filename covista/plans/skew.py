"""Joins whose output grows per key, kept even when one key holds most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.plans.shared import stored

# rows that a join may make from one key in one task
WORK_ROWS = 1_000_000


def spread(df: DataFrame) -> int:
    """Number of shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_counts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _l, _r): left and right rows of the keys on both sides."""
    return (left.groupBy(*keys).agg(F.count("*").alias("_l"))
            .join(right.groupBy(*keys).agg(F.count("*").alias("_r")), keys))


def hot_keys(left: DataFrame, right: DataFrame, keys: list[str], work_rows: int = WORK_ROWS) -> DataFrame:
    """(keys, _cuts, _slices): keys whose join makes over ``work_rows`` rows, and in how many parts
    to cut their left and right rows so that no two parts make more. The heavier side is cut more."""
    counts = key_counts(left, right, keys)
    parts = F.ceil(F.col("_l") * F.col("_r") / F.lit(float(work_rows)))
    cuts = F.greatest(F.lit(1), F.least(F.col("_l"), F.ceil(F.sqrt(parts * F.col("_l") / F.col("_r")))))
    slices = F.greatest(F.lit(1), F.least(F.col("_r"), F.ceil(parts / F.col("_cuts"))))
    return (counts.where(F.col("_l") * F.col("_r").cast("double") > work_rows)
            .withColumn("_cuts", cuts.cast("int")).withColumn("_slices", slices.cast("int")).select(*keys, "_cuts", "_slices"))


def fan_out_join(left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str | Column],
                 work_rows: int = WORK_ROWS) -> DataFrame:
    """Inner join for keys that match many rows on both sides.

    The rows a key makes are counted first, from both sides. Rows of a key that makes too many are cut
    in parts by a hash (on the left of ``spread_by``, on the right of the row) and every left part meets
    every right part in a task of its own. Without such a key this is the plain join, left to adaptive
    execution. Results are those of the plain join.
    """
    hot = stored(hot_keys(left, right, keys, work_rows), "hot-keys")
    if hot.isEmpty():
        return left.join(right, keys)
    cuts, slices = F.coalesce("_cuts", F.lit(1)), F.coalesce("_slices", F.lit(1))

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    cut = (left.join(hot, keys, "left").withColumn("_cut", F.pmod(F.xxhash64(*spread_by), cuts).cast("int"))
           .withColumn("_slice", every(slices)).drop("_cuts", "_slices"))
    sliced = (right.join(hot, keys, "left").withColumn("_slice", F.pmod(F.xxhash64(*right.columns), slices).cast("int"))
              .withColumn("_cut", every(cuts)).drop("_cuts", "_slices"))
    # a fixed partition number: the inputs are small next to what the join gives, so merging
    # partitions by input size would leave too few tasks
    tasks, together = spread(left), [*keys, "_cut", "_slice"]
    return cut.repartition(tasks, *together).join(sliced.repartition(tasks, *together), together).drop("_cut", "_slice")
