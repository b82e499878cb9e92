"""Exact nearest-neighbour and radius search over vector tables, without a cross join.

Catalogue vectors are assigned to cells around a bounded number of pivot vectors. For a seed
vector the triangle inequality bounds the best and worst cost any vector of a cell can have;
cells that cannot hold a result are not visited. Near cells are packed in blocks of bounded
size; a task holds a block, reads a share of the seeds that visit it as a stream, and hands on
at most k rows per seed (or the rows inside the radius). So a seed moves once per block, not
once per cell, and an item once per share.
A few seeds skip the cells: they travel with the code and the catalogue is scanned in place.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.functions import settled
from covista.plans.ranking import top_k
from covista.plans.shared import stored
from covista.plans.skew import spread

FEW_SEEDS = 64
MAX_PIVOTS = 512
CELL_ROWS = 2048  # catalogue rows per pivot, up to MAX_PIVOTS
BLOCK_VALUES = 1 << 22  # vector components of a block of the catalogue (32 MB)
COST_ROWS, COST_SEEDS = 1024, 512  # catalogue rows and seeds whose costs are held as one matrix (4 MB)
SHARE = 1 << 29  # costs that are worth a task of their own
SHARES = 2  # shares per shuffle partition

HITS = "seed_id long, item_id long, cost double"


def block_tools() -> SimpleNamespace:
    """What tasks need to meet blocks. Built inside a function so that executors need only numpy and arrow to run it."""

    class Block:
        """Catalogue rows in order of their cells, and the hits of seeds among them.

        Row costs are found by matrix products, cell by cell; what a product lets through is computed exactly. The k-th cost
        found so far bounds what later cells may add, and leaves out those that cannot.
        """

        def __init__(self, ids, matrix, cell, pivots, reach, longest, k, radius, metric, exclude_self):
            order = np.argsort(cell, kind="stable")
            self.ids, self.matrix, cell = ids[order], matrix[order], cell[order]
            self.kinds, starts = np.unique(cell, return_index=True)
            self.ends = [*zip(starts.tolist(), [*starts[1:].tolist(), len(cell)])]
            self.pivots, self.reach, self.longest = pivots[self.kinds], reach[self.kinds], longest[self.kinds]
            self.k, self.radius, self.metric, self.exclude_self = k, radius, metric, exclude_self
            self.half = (self.matrix**2).sum(1) / 2 if metric == "euclidean" else np.zeros(len(cell))
            self.norm = np.sqrt((self.matrix**2).sum(1).max(initial=0))

        def hits(self, seed_ids, seeds, allowed):
            """(seed row, item row, cost), in parts, for seeds whose bounds ``allowed`` say which cells they visit."""
            length2 = (seeds**2).sum(1)
            slack = 1e-6 * (1 + np.sqrt(length2) + self.norm)
            limit = np.full(len(seeds), np.inf if self.radius is None else self.radius)
            best = None if self.k is None else np.full((len(seeds), self.k), np.inf)
            low = bounds(seeds, self.pivots, self.reach, self.longest, self.metric)[0]
            edge = 1e-6 * (1 + np.sqrt(length2) + self.longest.max(initial=0) + self.reach.max(initial=0))
            found = []
            for c, (a, b) in enumerate(self.ends):
                rows = np.nonzero(~(low[:, c] > np.minimum(limit, allowed) + edge))[0]
                for at in range(a, b, COST_ROWS):
                    if len(rows):
                        some = self._some(seed_ids, seeds, rows, slice(at, min(b, at + COST_ROWS)), length2, slack, limit, best)
                        if self.k is None:
                            yield some
                        else:
                            found.append(some)
            if found:
                rows, cols, cost = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((self.ids[cols], np.round(cost, 9), rows))
                rows, cols, cost = rows[order], cols[order], cost[order]
                first = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < self.k
                yield rows[first], cols[first], cost[first]

        def _floor(self, limit, length2, slack):
            """The product, less half the item's square, that a cost within ``limit`` takes at least."""
            most = limit + slack
            return np.where(most < 0, np.inf, (length2 - most**2) / 2) if self.metric == "euclidean" else -most

        def _some(self, seed_ids, seeds, rows, part, length2, slack, limit, best):
            product = seeds[rows] @ self.matrix[part].T
            product -= self.half[part]
            if self.exclude_self:
                product[seed_ids[rows][:, None] == self.ids[part][None, :]] = -np.inf
            keep = product >= self._floor(limit[rows], length2[rows], slack[rows])[:, None]
            if self.k is not None and self.k <= product.shape[1] and np.count_nonzero(keep) > 4 * self.k * len(rows):
                kth = -np.partition(-product, self.k - 1, axis=1)[:, self.k - 1]
                near = np.sqrt(np.maximum(length2[rows] - 2 * kth, 0)) if self.metric == "euclidean" else -kth
                near = np.where(np.isfinite(kth), np.minimum(limit[rows], near), limit[rows])
                keep &= product >= self._floor(near, length2[rows], slack[rows])[:, None]
            at, cols = np.divmod(np.flatnonzero(keep), product.shape[1])
            finite = np.isfinite(product[at, cols])
            at, cols = at[finite], cols[finite] + part.start
            cost = np.empty(len(at))
            for i in range(0, len(at), 65536):
                x, y = seeds[rows[at[i:i + 65536]]], self.matrix[cols[i:i + 65536]]
                cost[i:i + 65536] = np.sqrt(((x - y) ** 2).sum(1)) if self.metric == "euclidean" else -(x * y).sum(1)
            if self.radius is not None:
                inside = np.round(cost, 9) <= self.radius
                at, cols, cost = at[inside], cols[inside], cost[inside]
            if best is not None and len(at):
                order = np.lexsort((cost, at))
                at, cols, cost = at[order], cols[order], cost[order]
                place = np.arange(len(at)) - np.searchsorted(at, at, side="left")
                few = place < self.k
                new = np.full((len(rows), self.k), np.inf)
                new[at[few], place[few]] = cost[few]
                some = np.unique(at)
                best[rows[some]] = np.sort(np.concatenate([best[rows[some]], new[some]], axis=1), axis=1)[:, :self.k]
                limit[rows[some]] = np.minimum(limit[rows[some]], best[rows[some], -1])
            return rows[at], cols, cost

    def bounds(seeds, pivots, reach, longest, metric):
        """(best, worst, at the pivot): what costs a seed's items of each cell can have."""
        length2 = (seeds**2).sum(1)[:, None]
        product = seeds @ pivots.T
        gap = np.sqrt(np.maximum(length2 + (pivots**2).sum(1)[None, :] - 2 * product, 0))
        near = np.maximum(gap - reach, 0)
        if metric == "euclidean":
            return near, gap + reach, gap
        length = np.sqrt(length2)
        # two upper bounds of the product: Cauchy-Schwarz around the pivot, and
        # 2 q.v = |q|^2 + |v|^2 - |q - v|^2
        return -np.minimum(product + length * reach, (length2 + longest**2 - near**2) / 2), -(product - length * reach), -product

    def runs(batches, names):
        """(values, slice of a batch) for each run of equal values of the named columns of a sorted stream."""
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(n)).to_numpy() for n in names]
            changes = np.zeros(batch.num_rows - 1, dtype=bool)
            for c in columns:
                changes |= c[1:] != c[:-1]
            edges = [0, *(np.nonzero(changes)[0] + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                yield tuple(c[a] for c in columns), batch.slice(a, b - a)

    def sides_met(batches):
        """(the items of a block as one table, a batch of the seeds that meet them), from rows sorted by block, group and side."""
        key, held, whole = None, [], None
        for (block, group, side), part in runs(batches, ["block", "group", "side"]):
            if (block, group) != key:
                key, held, whole = (block, group), [], None
            if side == 0:
                held.append(part)
            elif held:
                if whole is None:
                    whole = pa.Table.from_batches(held)
                yield whole, part

    def hit_batches(block, seed_ids, seeds, allowed):
        for rows, cols, cost in block.hits(seed_ids, seeds, allowed):
            yield pa.RecordBatch.from_arrays([pa.array(seed_ids[rows], pa.int64()), pa.array(block.ids[cols], pa.int64()), pa.array(cost)],
                                             ["seed_id", "item_id", "cost"])

    return SimpleNamespace(Block=Block, bounds=bounds, sides_met=sides_met, hit_batches=hit_batches)


def packed(counts, order, block_rows):
    """(first block, number of blocks) of each cell: cells go to blocks of up to ``block_rows`` rows in the given order, a
    larger cell to several of its own."""
    first, parts, block, room = np.zeros(len(counts), dtype=int), np.ones(len(counts), dtype=int), 0, block_rows
    for c in order:
        n = int(counts[c])
        if n > room and room < block_rows:
            block, room = block + 1, block_rows
        first[c], parts[c] = block, max(1, -(-n // block_rows))
        room -= n
        if room <= 0:
            block, room = block + int(parts[c]), block_rows
    return first, parts


def chained(points):
    """An order of a few points in which near ones mostly follow each other."""
    left, at, order = np.ones(len(points), dtype=bool), 0, []
    for _ in range(len(points)):
        order.append(at)
        left[at] = False
        at = int(np.where(left, ((points - points[at]) ** 2).sum(1), np.inf).argmin())
    return order


def groups_of(visits, rows, tasks):
    """Into how many groups the seeds of each block go, each a task's share: about ``tasks`` shares in all, or fewer if
    these would be smaller than ``SHARE`` costs."""
    work = np.asarray(visits, dtype=float) * np.asarray(rows, dtype=float)
    return np.ceil(work / max(SHARE, work.sum() / max(1, tasks))).astype(int)


def of(values, column):
    """The value at a place of a short list."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col(column) + 1)


def together(items, seeds):
    """Items (side 0) and seeds (side 1) with the same block and group, in one task and sorted."""
    rows = items.unionByName(seeds, allowMissingColumns=True)
    return rows.repartition(spread(rows) * SHARES, "block", "group").sortWithinPartitions("block", "group", "side")


def _reader(id_column, vector_column="vector"):
    """Function arrow table or batch -> (ids, matrix)."""

    def read(table):
        vectors = table.column(vector_column)
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        if len(sizes) and (odd := sizes != sizes[0]).any():
            at = int(odd.argmax())
            raise ValueError(f"{id_column} {table.column(id_column)[at]}: {sizes[at]} components, others have {sizes[0]}")
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        ids = table.column(id_column).to_numpy(zero_copy_only=False) if isinstance(
            table, pa.RecordBatch) else table.column(id_column).to_numpy()
        return ids, flat.reshape(len(ids), -1) if len(ids) else flat.reshape(0, 0)

    return read


def _matrix(rows, id_column):
    """The vectors of a few collected rows, after a look at their lengths."""
    for r in rows:
        if len(r["vector"]) != len(rows[0]["vector"]):
            raise ValueError(f"{id_column} {r[id_column]}: {len(r['vector'])} components, others have {len(rows[0]['vector'])}")
    return np.array([r["vector"] for r in rows], dtype=float)


def _pieces(rows=2048):
    """Function batches -> smaller non-empty batches, which bound the matrices made from them."""

    def pieces(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)

    return pieces


def _scan(seed_rows, items, k, radius, metric, exclude_self):
    """Seeds as constants of the tasks, one pass over the catalogue."""
    seed_ids = np.array([r["seed_id"] for r in seed_rows], dtype=np.int64)
    seeds = _matrix(seed_rows, "seed_id")
    read, pieces, tools = _reader("item_id"), _pieces(), block_tools()
    centre, none = np.zeros((1, seeds.shape[1])), np.full(1, np.inf)
    allowed = np.full(len(seeds), np.inf)

    def scan(batches):
        for batch in pieces(batches):
            ids, matrix = read(batch)
            block = tools.Block(ids, matrix, np.zeros(len(ids), dtype=int), centre, none, none, k, radius, metric, exclude_self)
            yield from tools.hit_batches(block, seed_ids, seeds, allowed)

    return items.mapInArrow(scan, HITS)


def _assign(items, pivots):
    """Add the nearest pivot, the distance to it and the length of the vector."""
    read, pieces = _reader("item_id"), _pieces()

    def assign(batches):
        norms = (pivots**2).sum(1)
        for batch in pieces(batches):
            _, matrix = read(batch)
            cell = (norms[None, :] - 2 * matrix @ pivots.T).argmin(1)
            gap = np.sqrt(((matrix - pivots[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), batch.column("vector"), pa.array(cell.astype(np.int32)),
                 pa.array(gap), pa.array(np.sqrt((matrix**2).sum(1)))],
                ["item_id", "vector", "cell", "gap", "norm"])

    return items.mapInArrow(assign, "item_id long, vector array<double>, cell int, gap double, norm double")


def _probe(seeds, pivots, cells, member, need, radius, metric):
    """Add to every seed the list of blocks with cells that may hold one of its results, and the bound that says which."""
    read, pieces, bounds = _reader("seed_id"), _pieces(), block_tools().bounds
    count, reach, longest = cells["count"], cells["reach"], cells["norm"]

    def probe(batches):
        for batch in pieces(batches):
            _, matrix = read(batch)
            length2 = (matrix**2).sum(1)
            best, worst, at_pivot = bounds(matrix, pivots, reach, longest, metric)
            limit = np.full(len(matrix), np.inf)
            if need is not None:
                order = np.argsort(worst, axis=1)
                filled = np.cumsum(count[order], axis=1) >= need
                place = filled.argmax(1)
                rows = np.arange(len(matrix))
                enough = filled[rows, place]
                limit = np.where(enough, worst[rows, order[rows, place]], np.inf)
                if need <= len(pivots):  # pivots are catalogue vectors themselves
                    limit = np.minimum(limit, np.partition(at_pivot, need - 1, axis=1)[:, need - 1])
            if radius is not None:
                limit = np.minimum(limit, radius)
            slack = 1e-6 * (1 + np.sqrt(length2) + longest.max() + reach.max())
            hits = (best <= (limit + slack)[:, None]) & (count > 0)[None, :]
            visited = hits.astype(np.float32) @ member > 0
            offsets = np.concatenate([[0], np.cumsum(visited.sum(1))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("seed_id"), batch.column("vector"), pa.array(limit),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.nonzero(visited)[1], pa.int32()))],
                ["seed_id", "vector", "limit", "blocks"])

    return seeds.mapInArrow(probe, "seed_id long, vector array<double>, limit double, blocks array<int>")


def _by_cells(seeds, items, k, radius, metric, exclude_self, block_values, cell_rows):
    total = items.count()
    if total == 0:
        return seeds.sparkSession.createDataFrame([], HITS)
    n_pivots = min(MAX_PIVOTS, -(-total // cell_rows))
    picked = items.orderBy(F.xxhash64("item_id"), "item_id").limit(n_pivots).collect()  # <= MAX_PIVOTS rows
    pivots = _matrix(picked, "item_id")
    block_rows = max(1, block_values // max(1, pivots.shape[1]))

    placed = stored(_assign(items, pivots), "placed-vectors")
    stats = (placed.groupBy("cell")
             .agg(F.count("*").alias("n"), F.max("gap").alias("gap"), F.max("norm").alias("norm"))
             .collect())  # one row per pivot
    cells = {name: np.zeros(len(pivots)) for name in ("count", "reach", "norm")}
    for row in stats:
        cells["count"][row["cell"]] = row["n"]
        cells["reach"][row["cell"]] = row["gap"]
        cells["norm"][row["cell"]] = row["norm"]
    first, parts = packed(cells["count"], chained(pivots), block_rows)
    n_blocks = int((first + parts).max())
    at = np.arange(n_blocks)[None, :]
    member = ((at >= first[:, None]) & (at < (first + parts)[:, None])).astype(np.float32)

    need = None if k is None else k + int(exclude_self)
    probes = stored(_probe(seeds, pivots, cells, member, need, radius, metric), "probes")
    visits = {r["block"]: r["n"] for r in probes.select(F.explode("blocks").alias("block"))
              .groupBy("block").agg(F.count("*").alias("n")).collect()}  # one row per block
    groups = groups_of([visits.get(b, 0) for b in range(n_blocks)], (cells["count"] / parts) @ member, spread(seeds) * SHARES)

    block = of(first, "cell") + F.pmod(F.xxhash64("item_id"), of(parts, "cell")).cast("int")
    left = (placed.select(F.col("item_id").alias("id"), "vector", "cell", block.alias("block")).where(of(groups, "block") > 0)
            .withColumn("group", F.explode(F.sequence(F.lit(0), of(groups, "block") - 1))).withColumn("side", F.lit(0)))
    right = (probes.select(F.col("seed_id").alias("id"), "vector", "limit", F.explode("blocks").alias("block"))
             .withColumn("group", F.pmod(F.xxhash64("id"), of(groups, "block")).cast("int")).withColumn("side", F.lit(1)))
    read, pieces, tools = _reader("id"), _pieces(COST_SEEDS), block_tools()
    reach, longest = cells["reach"], cells["norm"]

    def meet(batches):
        last, block = None, None
        for table, wanted in tools.sides_met(batches):
            if table is not last:
                ids, matrix = read(table)
                last, block = table, tools.Block(ids, matrix, table.column("cell").to_numpy(), pivots, reach, longest, k, radius, metric, exclude_self)
            for batch in pieces([wanted]):
                seed_ids, matrix = read(batch)
                yield from tools.hit_batches(block, seed_ids, matrix, batch.column("limit").to_numpy())

    return together(left, right).mapInArrow(meet, HITS)


def search(seeds: DataFrame, items: DataFrame, k: int | None = None, radius: float | None = None,
           metric: str = "euclidean", exclude_self: bool = False, few_seeds: int = FEW_SEEDS,
           block_values: int = BLOCK_VALUES, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The k nearest items of every seed, and/or all items within ``radius``.

    ``seeds(seed_id, vector)`` and ``items(item_id, vector)``; rows without a vector are left
    out. ``metric`` is euclidean (cost = distance), cosine or dot (cost = minus the product).
    Gives (seed_id, item_id, cost), plus ``rank`` when k is set; ties go to the lower id.
    """
    if metric not in ("euclidean", "cosine", "dot"):
        raise ValueError(f"unknown metric {metric!r}")
    if k is None and radius is None:
        raise ValueError("give k, a radius or both")

    def clean(df, name):
        vector = F.col("vector").cast("array<double>")
        df = df.where(F.col("vector").isNotNull()).select(F.col(name).cast("long").alias(name), vector.alias("vector"))
        if metric == "cosine":
            length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v))
            unit = F.when(F.col("length") == 0, F.col("vector")).otherwise(
                F.transform("vector", lambda v: v / F.col("length")))
            df = df.withColumn("length", length).select(name, unit.alias("vector"))
        return df

    seeds, items = clean(seeds, "seed_id"), clean(items, "item_id")
    inner = "euclidean" if metric == "euclidean" else "dot"
    head = seeds.limit(few_seeds + 1).collect()
    if len(head) == 0:
        hits = seeds.sparkSession.createDataFrame([], HITS)
    elif len(head) <= few_seeds:
        hits = _scan(head, items, k, radius, inner, exclude_self)
    else:
        hits = _by_cells(seeds, items, k, radius, inner, exclude_self, block_values, cell_rows)
    if k is None:
        return hits
    return top_k(hits, ["seed_id"], [settled(F.col("cost")), F.col("item_id")], k)
