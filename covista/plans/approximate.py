"""Approximate nearest neighbours: cells, residual product codes, exact distances for a shortlist.

An index has a cell and a short code per vector. The cells are those around the centres of a bounded sample; the
code names, for each group of components, the nearest of 256 typical residuals to the cell's centre. A seed visits
its nearest cells. Near cells are packed in blocks; a task holds a block and reads a share of its seeds as a stream,
scores the visited cells by their codes, and hands on the k rows of a seed's shortlist with the least exact distances. How many cells to visit is measured: on a bounded sample of vectors, whose exact
neighbours are found by a scan, as many as hold the wanted share of these. ``search`` remains the exact way.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.functions import settled
from covista.plans.ranking import top_k
from covista.plans.search import HITS, SHARES, _matrix, _pieces, _reader, block_tools, chained, groups_of, of, packed, search, together
from covista.plans.shared import stored
from covista.plans.skew import spread

SAMPLE_ROWS = 16_384  # vectors that centres and codes are fitted on
TRIAL_SEEDS = 64  # vectors whose exact neighbours say how many cells to visit
MAX_CELLS = 1024
GROUPS, WORDS = 16, 256  # bytes per code, values of a byte
BLOCK_ROWS = 65_536  # items of near cells that one task holds
COSTS = 1 << 22  # rough costs that are held as one matrix (32 MB)
SHORTLIST = 30  # exact distances per wanted neighbour

CODES = "item_id long, cell int, code binary"


def _centres(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spaced rows of a hashed, hence shuffled, sample. An empty centre stays."""
    at = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = ((at**2).sum(1)[None, :] - 2 * rows @ at.T).argmin(1)
        size = np.bincount(near, minlength=k)
        for d in range(rows.shape[1]):
            total = np.bincount(near, weights=rows[:, d], minlength=k)
            at[size > 0, d] = total[size > 0] / size[size > 0]
    return at


@dataclass(frozen=True)
class Index:
    """``codes(item_id, cell, code)`` of all items, and the bounded tables they refer to."""

    codes: DataFrame
    items: DataFrame
    centres: np.ndarray
    words: tuple[np.ndarray, ...]
    metric: str
    sizes: tuple[int, ...]


def _clean(df: DataFrame, name: str, metric: str) -> DataFrame:
    if metric not in ("euclidean", "cosine"):
        raise ValueError(f"approximate search knows euclidean and cosine, not {metric!r}")
    df = df.where(F.col("vector").isNotNull()).select(F.col(name).cast("long").alias(name),
                                                      F.col("vector").cast("array<double>").alias("vector"))
    if metric == "cosine":  # on unit vectors distance and cosine order alike; a zero vector stays
        df = df.withColumn("length", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v)))
        df = df.select(name, F.when(F.col("length") == 0, F.col("vector")).otherwise(
            F.transform("vector", lambda v: v / F.col("length"))).alias("vector"))
    return df


def build_index(items: DataFrame, metric: str = "euclidean", cells: int | None = None,
                sample_rows: int = SAMPLE_ROWS) -> Index:
    """Index of ``items(item_id, vector)``; rows without a vector are left out. ``cells`` is the root of their number
    unless given, at most ``MAX_CELLS``. The sample is taken by hash of the id: the same on every run."""
    items = stored(_clean(items, "item_id", metric), "indexed-vectors")
    picked = items.orderBy(F.xxhash64("item_id"), "item_id").limit(sample_rows).collect()
    if not picked:
        return Index(items.sparkSession.createDataFrame([], CODES), items, np.zeros((0, 0)), (), metric, ())
    sample = _matrix(picked, "item_id")
    k = max(1, min(MAX_CELLS, len(sample), cells or round(math.sqrt(items.count()))))
    centres = _centres(sample, k)
    near = ((centres**2).sum(1)[None, :] - 2 * sample @ centres.T).argmin(1)
    rest = sample - centres[near]
    spans = [s for s in np.array_split(np.arange(sample.shape[1]), min(GROUPS, sample.shape[1]))]
    words = tuple(_centres(rest[:, s], min(WORDS, len(rest))) for s in spans)
    read, pieces = _reader("item_id"), _pieces()

    def encode(batches):
        for batch in pieces(batches):
            _, matrix = read(batch)
            cell = ((centres**2).sum(1)[None, :] - 2 * matrix @ centres.T).argmin(1)
            left = matrix - centres[cell]
            code = np.stack([((w**2).sum(1)[None, :] - 2 * left[:, s] @ w.T).argmin(1) for s, w in zip(spans, words)], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(cell.astype(np.int32)), pa.array([row.tobytes() for row in code.astype(np.uint8)])],
                ["item_id", "cell", "code"])

    codes = stored(items.mapInArrow(encode, CODES), "codes")
    sizes = {r["cell"]: r["count"] for r in codes.groupBy("cell").count().collect()}  # one row per cell
    return Index(codes, items, centres, words, metric, tuple(sizes.get(c, 0) for c in range(k)))


def cells_to_visit(index: Index, k: int, share: float, exclude_self: bool = False) -> int:
    """As many nearest cells as hold ``share`` of the exact k neighbours of a sample of the items."""
    trial = index.items.orderBy(F.xxhash64("item_id", F.lit(1)), "item_id").limit(TRIAL_SEEDS)
    trial = stored(trial.select(F.col("item_id").alias("seed_id"), "vector"), "trial-seeds")
    hits = search(trial, index.items, k=k, exclude_self=exclude_self)
    found = hits.join(index.codes.select("item_id", "cell"), "item_id").select("seed_id", "cell").collect()  # TRIAL_SEEDS * k rows
    seeds = trial.collect()
    if not found:
        return 1
    matrix = _matrix(seeds, "seed_id")
    order = ((index.centres**2).sum(1)[None, :] - 2 * matrix @ index.centres.T).argsort(1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape).copy(), 1)
    row = {r["seed_id"]: i for i, r in enumerate(seeds)}
    needed = np.sort([place[row[r["seed_id"]], r["cell"]] + 1 for r in found])
    return int(needed[min(len(needed) - 1, math.ceil(share * len(needed)) - 1)])


def approximate_search(seeds: DataFrame, index: Index, k: int, share: float = 0.97, visits: int | None = None,
                       shortlist: int = SHORTLIST, exclude_self: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(seed_id, item_id, cost, rank): about the k nearest items of every seed, with exact costs (distance, or minus
    the cosine). ``visits`` cells per seed, else as many as the sample says for ``share``; a seed gets fewer than k
    rows only if the cells it visits hold fewer. Ties go to the lower id."""
    seeds = _clean(seeds, "seed_id", index.metric)
    if not len(index.centres):
        return seeds.sparkSession.createDataFrame([], "seed_id long, item_id long, cost double, rank int")
    centres, words = index.centres, index.words
    visits = min(len(centres), visits or cells_to_visit(index, k, share, exclude_self))
    read, pieces = _reader("seed_id"), _pieces()

    def probe(batches):
        for batch in pieces(batches):
            _, matrix = read(batch)
            far = (centres**2).sum(1)[None, :] - 2 * matrix @ centres.T
            order = far.argsort(1, kind="stable")[:, :visits]
            limit = np.take_along_axis(far, order[:, -1:], 1)[:, 0]
            inside = np.zeros(far.shape, dtype=np.float32)
            np.put_along_axis(inside, order, 1, 1)
            blocks = inside @ member > 0
            ends = np.concatenate([[0], np.cumsum(blocks.sum(1))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("seed_id"), batch.column("vector"), pa.array(limit + 1e-9 * (1 + np.abs(limit))),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.nonzero(blocks)[1], pa.int32()))],
                ["seed_id", "vector", "limit", "blocks"])

    first, parts = packed(index.sizes, chained(centres), block_rows)
    n_blocks = int((first + parts).max())
    at = np.arange(n_blocks)[None, :]
    member = ((at >= first[:, None]) & (at < (first + parts)[:, None])).astype(np.float32)
    probes = stored(seeds.mapInArrow(probe, "seed_id long, vector array<double>, limit double, blocks array<int>"), "visits")
    visited = {r["block"]: r["n"] for r in probes.select(F.explode("blocks").alias("block"))
               .groupBy("block").agg(F.count("*").alias("n")).collect()}  # one row per block
    groups = groups_of([visited.get(b, 0) for b in range(n_blocks)], (np.array(index.sizes) / parts) @ member, spread(seeds) * SHARES)

    block = of(first, "cell") + F.pmod(F.xxhash64("item_id"), of(parts, "cell")).cast("int")
    left = (index.codes.join(index.items, "item_id").select(F.col("item_id").alias("id"), "vector", "cell", "code", block.alias("block"))
            .where(of(groups, "block") > 0)
            .withColumn("group", F.explode(F.sequence(F.lit(0), of(groups, "block") - 1))).withColumn("side", F.lit(0)))
    right = (probes.select(F.col("seed_id").alias("id"), "vector", "limit", F.explode("blocks").alias("block"))
             .withColumn("group", F.pmod(F.xxhash64("id"), of(groups, "block")).cast("int")).withColumn("side", F.lit(1)))
    spans = [s for s in np.array_split(np.arange(centres.shape[1]), len(words))]
    short, metric = k * shortlist, index.metric
    read_met, tools = _reader("id"), block_tools()

    def meant(codes, cell):
        """The vectors that the codes stand for."""
        code = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(cell), -1)
        out = centres[cell]
        for g, (s, w) in enumerate(zip(spans, words)):
            out[:, s] += w[code[:, g]]
        return out

    def near(seed_ids, seeds, limit, ids, matrix, cell, coded, half):
        """(seed row, item row, cost): of the visited cells' items the shortlist by codes, of it the k best by exact cost."""
        rough = np.full((len(seeds), len(ids)), np.inf)
        kinds, starts = np.unique(cell, return_index=True)
        visited = (centres[kinds]**2).sum(1)[None, :] - 2 * seeds @ centres[kinds].T <= limit[:, None]
        for c, (a, b) in enumerate(zip(starts, [*starts[1:], len(cell)])):
            rows = np.nonzero(visited[:, c])[0]
            if len(rows):
                rough[rows, a:b] = half[a:b] - seeds[rows] @ coded[a:b].T
        if exclude_self:
            rough[seed_ids[:, None] == ids[None, :]] = np.inf
        if short < len(ids):
            cols = np.argpartition(rough, short - 1, axis=1)[:, :short]
        else:
            cols = np.broadcast_to(np.arange(len(ids)), rough.shape)
        rows = np.repeat(np.arange(len(seeds)), cols.shape[1])
        cols = cols.ravel()
        listed = np.isfinite(rough[rows, cols])
        rows, cols = rows[listed], cols[listed]
        cost = np.empty(len(rows))
        for i in range(0, len(rows), 65536):
            x, y = seeds[rows[i:i + 65536]], matrix[cols[i:i + 65536]]
            cost[i:i + 65536] = np.sqrt(((x - y) ** 2).sum(1)) if metric == "euclidean" else -(x * y).sum(1)
        order = np.lexsort((ids[cols], np.round(cost, 9), rows))
        rows, cols, cost = rows[order], cols[order], cost[order]
        kept = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
        return rows[kept], cols[kept], cost[kept]

    def meet(batches):
        last, ids, held = None, None, ()
        for table, wanted in tools.sides_met(batches):
            if table is not last:
                ids, matrix = read_met(table)
                cell = table.column("cell").to_numpy()
                order = np.argsort(cell, kind="stable")
                coded = meant(table.column("code"), cell)[order]
                last, ids = table, ids[order]
                held = (ids, matrix[order], cell[order], coded, (coded**2).sum(1) / 2)
            step = max(1, COSTS // max(1, len(ids)))  # bounds the matrix of rough costs
            for at in range(0, wanted.num_rows, step):
                batch = wanted.slice(at, step)
                seed_ids, vectors = read_met(batch)
                rows, cols, cost = near(seed_ids, vectors, batch.column("limit").to_numpy(), *held)
                yield pa.RecordBatch.from_arrays([pa.array(seed_ids[rows], pa.int64()), pa.array(ids[cols], pa.int64()), pa.array(cost)],
                                                 ["seed_id", "item_id", "cost"])

    costs = together(left, right).mapInArrow(meet, HITS)
    return top_k(costs, ["seed_id"], [settled(F.col("cost")), F.col("item_id")], k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: share of the rows of ``exact`` that ``found`` has, by (seed_id, item_id)."""
    hit = found.select("seed_id", "item_id", F.lit(1).alias("hit"))
    return exact.join(hit, ["seed_id", "item_id"], "left").agg(
        F.coalesce(F.count("hit") / F.count("*"), F.lit(1.0)).alias("recall"))
