"""The largest products of every seed with a catalogue of vectors, for tables of factors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.plans.ranking import top_k
from covista.plans.search import SHARE, _pieces, _reader, block_tools
from covista.plans.skew import spread

BLOCK_FLOATS = 1 << 24  # components of a block of items (64 MB)
SEED_ROWS, FIRST_ITEMS, ITEM_ROWS = 256, 512, 4096  # seeds and items whose products are held as one matrix (4 MB)


def best_of(y, k):
    """Function seeds -> (seed row, item row, product, place from 0) of the k items ``y`` with the largest products. Of equal
    ones the earlier item row comes first."""
    longest = np.sqrt(max([0.0, *((y[at:at + 65536].astype(float)**2).sum(1).max() for at in range(0, len(y), 65536))]))

    def exact(x, rows, cols):
        out = np.empty(len(rows))
        for at in range(0, len(rows), 65536):
            some = slice(at, at + 65536)
            out[some] = (x[rows[some]].astype(float) * y[cols[some]]).sum(1)
        return out

    def true_places(near):
        if near.size % 8:
            return np.flatnonzero(near)
        words = np.flatnonzero(near.reshape(-1).view(np.uint64))  # few are true: eight at a time
        word, at = np.nonzero(near.reshape(-1, 8)[words])
        return words[word] * 8 + at

    def best(x):
        # what products of floats may be wrong by
        slack = x.shape[1] * 2.0**-23 * longest * np.sqrt((x.astype(float)**2).sum(1))
        floor = np.full(len(x), -np.inf)
        rows, cols, score = np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0)
        place, at, step = rows, 0, max(FIRST_ITEMS, 2 * k)
        while at < len(y):
            product = x @ y[at:at + step].T
            if at == 0:
                low = np.partition(product, -k, axis=1)[:, -k] - 2 * slack if product.shape[1] > k else floor
                near = product >= low.astype(np.float32)[:, None]
            else:
                near = product > (floor - slack).astype(np.float32)[:, None]
            new, c = np.divmod(true_places(near), product.shape[1])
            if len(new):
                rows, cols, score = np.concatenate([rows, new]), np.concatenate([cols, c + at]), np.concatenate([score, exact(x, new, c + at)])
                order = np.lexsort((cols, -score, rows))
                rows, cols, score = rows[order], cols[order], score[order]
                place = np.arange(len(rows)) - np.searchsorted(rows, rows)
                first = place < k
                rows, cols, score, place = rows[first], cols[first], score[first], place[first]
                floor[rows[place == k - 1]] = score[place == k - 1]
            at, step = at + product.shape[1], min(2 * step, max(ITEM_ROWS, step))
        return rows, cols, score, place

    return best


def best_products(seeds: DataFrame, items: DataFrame, k: int, block_floats: int = BLOCK_FLOATS) -> DataFrame:
    """(seed_id, item_id, score, rank): the k items with the largest products with a seed, by ``(id, vector)`` of both.

    Every seed meets every item. Items are cut in blocks of bounded size and seeds in groups; a task holds a block, reads
    a group as a stream, finds what may be among the k best by products of matrices of floats and computes that exactly,
    and hands on k rows a seed. Ties go to the lower id.
    """
    width, n = items.agg(F.max(F.size("vector")), F.count("*")).first()
    asked = seeds.count()
    blocks = max(1, -(-n * (width or 0) // block_floats))
    # items go to all groups and seeds to all blocks: more groups than Spark has partitions only as long as seeds move more
    groups = max(1, min(-(-asked * n // blocks // SHARE), max(spread(seeds), asked * blocks // max(1, n))))
    left = (items.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("side"))
            .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    right = (seeds.select("id", "vector", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("side"))
             .withColumn("group", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")))
    read, pieces, tools = _reader("id"), _pieces(SEED_ROWS), block_tools()

    def meet(batches):
        last, ids, best = None, None, None
        for table, wanted in tools.sides_met(batches):
            if table is not last:
                ids, matrix = read(table)
                order = np.argsort(ids, kind="stable")
                last, ids, best = table, ids[order], best_of(matrix[order], k)
            for batch in pieces([wanted]):
                seed_ids, x = read(batch)
                rows, cols, score, place = best(x)
                yield pa.RecordBatch.from_arrays([pa.array(seed_ids[rows], pa.int64()), pa.array(ids[cols], pa.int64()), pa.array(score),
                                                  pa.array((place + 1).astype(np.int32))], ["seed_id", "item_id", "score", "rank"])

    rows = (left.unionByName(right).repartitionById(blocks * groups, (F.col("block") * groups + F.col("group")).cast("int"))
            .sortWithinPartitions("block", "group", "side"))
    found = rows.mapInArrow(meet, "seed_id long, item_id long, score double, rank int")
    return found if blocks == 1 else top_k(found.drop("rank"), ["seed_id"], [F.desc("score"), F.asc("item_id")], k)
