"""Hard negatives: for an anchor and one of its positives, rows of other labels that score nearly as high.

Candidates are numbered by label and by the nearest of a few pivots (those of a bounded sample) and cut in blocks of
``BLOCK`` rows. Each block becomes a cover tree. A vector x is given one more component, sqrt(M^2 - |x|^2), so that all
candidates have norm M and a query, whose added component is 0, keeps its inner products. On that sphere the order
by inner product is the order by angle: a node whose centre lies at angle t from the query, and whose rows lie
within its covering angle p, holds inner products between |q| M cos(t + p) and |q| M cos(t - p) only. Centres are chosen
farthest first; those chosen before the covering distance halves form a level, so every level covers the block within its
own radius, which is then measured and not just bounded.

A search goes through a tree best-first, from the highest bound down. Nodes that lie above or below all windows of the
anchor, or below the last kept row of every window, are passed over; rows of the others are scored exactly in whole
numbers. Every anchor meets every block that may hold an answer, groups of anchors by blocks, and a cell hands on
a few rows a window. The first search finds positives (the best rows of the same label), the second one negatives.

Rows with a null label, a null vector or a component that is null, NaN or infinite take no part. Components become
floor(scale x); missing ones of a shorter vector count as 0. Scores beyond 64 bits are held at the end of the range.
Ties go to the smaller id, null ids last; rows with equal ids are rows of their own. An anchor without positives, and a
window without rows, gives none, and so does an empty table. Only the named columns are read.
"""

from __future__ import annotations

import heapq
import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.plans import Workspace, fan_out_join, top_k, with_ordinal

BLOCK = 8192
LEAF = 256
GROUP = 4096
PIVOTS = 64
SAMPLE = 4096
# whole numbers up to here are exact in a product of doubles
EXACT = float(1 << 52)
ENDS = (-(1 << 63), (1 << 63) - 1)
# angles near 0 are known to the root of the precision of doubles
SLACK = 1e-6


def whole(vectors: list, scale: float) -> np.ndarray:
    """floor(scale x) of vectors, shorter ones filled with 0."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(scale * out))


def longest(rows: np.ndarray) -> float:
    """The largest norm of the rows."""
    with np.errstate(over="ignore"):
        return float(np.sqrt((rows * rows).sum(1).max(initial=0.0)))


def products(rows: np.ndarray, q: np.ndarray, most: float | None = None) -> np.ndarray:
    """Inner products in whole numbers, held within 64 bits. ``most``: their largest absolute value, if known."""
    if most is None:
        most = longest(rows) * longest(q[None, :])
    if most < EXACT:
        return (rows @ q).astype(np.int64)
    exact = [int(x) for x in q]
    sums = (sum(int(a) * b for a, b in zip(r, exact)) for r in rows)
    return np.array([min(max(s, ENDS[0]), ENDS[1]) for s in sums], dtype=np.int64)


def fitted(a: np.ndarray, width: int) -> np.ndarray:
    """Rows cut or filled up to a width: components beyond a tree's own meet only zeros."""
    out = np.zeros((len(a), width))
    out[:, :min(width, a.shape[1])] = a[:, :width]
    return out


class CoverTree:
    """Rows in order of their leaves, centres, and per node its centre, covering angle and children."""

    def __init__(self, rows: np.ndarray, leaf: int):
        n = len(rows)
        largest = float(np.abs(rows).max(initial=0.0)) or 1.0
        unit = rows / largest
        norms = (unit * unit).sum(1)
        radius = math.sqrt(norms.max(initial=0.0))
        sphere = np.hstack([unit, np.sqrt(np.maximum(radius * radius - norms, 0.0))[:, None]])
        sphere = sphere / radius if radius else sphere
        centres, levels = self._farthest_first(sphere, max(1, n // leaf))
        # the place of each row at each level, from the leaves up
        cosines = sphere @ sphere[centres].T
        own = cosines.argmax(1)
        of_centre = sphere[centres] @ sphere[centres].T
        places = [own]
        for m in reversed(levels[:-1]):
            parent = of_centre[:, :m].argmax(1)
            parent[:m] = np.arange(m)
            places.insert(0, parent[places[0]])
        self.order = np.argsort(own, kind="stable")
        self.radius = radius * largest
        self.node_centre, self.node_angle, self.children, ids = [], [], [], []
        for place in places:
            least = np.full(len(centres), 1.0)
            np.minimum.at(least, place, cosines[np.arange(n), place])
            ids.append({})
            for c in np.unique(place):
                ids[-1][int(c)] = len(self.node_centre)
                self.node_centre.append(int(c))
                self.node_angle.append(math.acos(max(-1.0, min(1.0, float(least[c])))))
                self.children.append([])
        for upper, lower, up, low in zip(ids, ids[1:], places, places[1:]):
            for u, w in {(int(a), int(b)) for a, b in zip(up, low)}:
                self.children[upper[u]].append(lower[w])
        ends = np.searchsorted(own[self.order], np.arange(len(centres) + 1))
        self.leaves = {i: (int(ends[c]), int(ends[c + 1])) for c, i in ids[-1].items()}
        self.node_centre, self.node_angle = np.array(self.node_centre), np.array(self.node_angle)
        self.at_centre = rows[centres]

    @staticmethod
    def _farthest_first(sphere: np.ndarray, most: int) -> tuple[list[int], list[int]]:
        """Centres, each the row farthest from those before, and the number of them at each level."""
        centres, levels = [0], []
        apart = 2 - 2 * (sphere @ sphere[0])
        reach = None
        while len(centres) < most:
            at = int(apart.argmax())
            gap = math.sqrt(max(0.0, float(apart[at])))
            if gap <= 1e-6:
                break
            if reach is None or gap <= reach / 2:
                levels.append(len(centres))
                reach = gap
            centres.append(at)
            apart = np.minimum(apart, 2 - 2 * (sphere @ sphere[at]))
        return centres, [*levels, len(centres)]

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest inner product that each node may hold."""
        with np.errstate(over="ignore"):
            size = float(np.sqrt(q @ q))
            reach = size * self.radius
        if not reach or not math.isfinite(reach):
            edge = np.full(len(self.node_centre), reach)
            return -edge, edge
        angle = np.arccos(np.clip((self.at_centre / self.radius) @ (q / size), -1.0, 1.0))[self.node_centre]
        slack = SLACK * reach + 1
        # scores are held in 64 bits, whose last double is 1,023 below the end
        return (np.minimum(reach * np.cos(np.minimum(math.pi, angle + self.node_angle)) - slack, ENDS[1] - 1023),
                np.maximum(reach * np.cos(np.maximum(0.0, angle - self.node_angle)) + slack, ENDS[0]))


class Block:
    """The rows of a block with their tree, as kept in the index."""

    def __init__(self, places: np.ndarray, ids: np.ndarray, known: np.ndarray, labels: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        self.tree = CoverTree(rows, leaf)
        order = self.tree.order
        self.places, self.ids, self.known, self.labels, self.rows = places[order], ids[order], known[order], labels[order], rows[order]
        self.longest = longest(rows)

    def best(self, q: np.ndarray, windows: list[tuple[int, int]], count: int, allowed: np.ndarray, visited: list | None = None) -> list[list[tuple]]:
        """Per window the first ``count`` allowed rows with scores inside it: (-score, id unknown, id, place)."""
        least, most = self.tree.bounds(q)
        size = self.longest * longest(q[None, :])
        kept: list[list[tuple]] = [[] for _ in windows]

        def needed(i: int) -> bool:
            return any(least[i] <= high and most[i] >= (max(low, -k[-1][0]) if len(k) == count else low)
                       for (low, high), k in zip(windows, kept))

        lowest, highest = min(low for low, _ in windows), max(high for _, high in windows)
        heap = [(-most[0], 0)]
        while heap:
            _, i = heapq.heappop(heap)
            if not needed(i):
                continue
            if i not in self.tree.leaves:
                for c in self.tree.children[i]:
                    if needed(c):
                        heapq.heappush(heap, (-most[c], c))
                continue
            a, b = self.tree.leaves[i]
            if visited is not None:
                visited.append(b - a)
            scores = products(self.rows[a:b], q, size)
            inside = np.nonzero(allowed[a:b] & (scores >= lowest) & (scores <= highest))[0]
            if not len(inside):
                continue
            for w, (low, high) in enumerate(windows):
                low = max(low, -kept[w][-1][0]) if len(kept[w]) == count else low
                found = inside[(scores[inside] >= low) & (scores[inside] <= high)]
                if len(found) > count:
                    found = found[np.lexsort((self.places[a:b][found], self.ids[a:b][found], ~self.known[a:b][found], -scores[found]))[:count]]
                if len(found):
                    more = [(-int(scores[j]), not self.known[a + j], int(self.ids[a + j]), int(self.places[a + j])) for j in found]
                    kept[w] = sorted(kept[w] + more)[:count]
        return kept

    def packed(self) -> bytes:
        t, out = self.tree, io.BytesIO()
        flat = [(c, i) for c, cs in enumerate(t.children) for i in cs]
        small = self.rows.astype(np.int32) if np.abs(self.rows).max(initial=0.0) < 1 << 31 else self.rows
        np.savez(out, places=self.places, ids=self.ids, known=self.known, labels=self.labels, rows=small, at_centre=t.at_centre,
                 node_centre=t.node_centre, node_angle=t.node_angle, radius=t.radius, edges=np.array(flat, dtype=np.int64).reshape(-1, 2),
                 leaves=np.array([(i, a, b) for i, (a, b) in t.leaves.items()], dtype=np.int64).reshape(-1, 3))
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Block:
        held = np.load(io.BytesIO(data))
        block, tree = cls.__new__(cls), CoverTree.__new__(CoverTree)
        block.places, block.ids, block.known, block.labels = (held[k] for k in ("places", "ids", "known", "labels"))
        block.rows, block.tree = held["rows"].astype(float), tree
        block.longest = longest(block.rows)
        tree.at_centre, tree.node_centre, tree.node_angle, tree.radius = held["at_centre"], held["node_centre"], held["node_angle"], float(held["radius"])
        tree.children = [[] for _ in tree.node_centre]
        for up, low in held["edges"]:
            tree.children[up].append(int(low))
        tree.leaves = {int(i): (int(a), int(b)) for i, a, b in held["leaves"]}
        return block


def taking_part(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, vector) of the rows that have a label and a vector of finite numbers."""
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (df.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
            .where(F.col("label").isNotNull() & x.isNotNull() & finite))


def pivots(rows: DataFrame, scale: float) -> np.ndarray:
    """Up to ``PIVOTS`` rows far apart, of a sample of ``SAMPLE`` rows chosen by hash."""
    sample = [r["vector"] for r in rows.orderBy(F.xxhash64("id", "label", "vector")).limit(SAMPLE).select("vector").collect()]
    if not sample:
        return np.zeros((1, 0))
    spread_out = whole(sample, scale)
    spread_out /= np.abs(spread_out).max(initial=0.0) or 1.0
    chosen, apart = [0], ((spread_out - spread_out[0]) ** 2).sum(1)
    while len(chosen) < min(PIVOTS, len(spread_out)) and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, ((spread_out - spread_out[chosen[-1]]) ** 2).sum(1))
    return whole([sample[i] for i in chosen], scale)


def numbered(rows: DataFrame, scale: float) -> DataFrame:
    """(id, label, vector, place, block): rows in order of label and nearest pivot."""
    centres = pivots(rows, scale)

    @F.arrow_udf("int")
    def cell(vectors: pa.Array) -> pa.Array:
        x = fitted(whole(vectors.to_pylist(), scale), centres.shape[1])
        size = max(np.abs(centres).max(initial=0.0), np.abs(x).max(initial=0.0)) or 1.0
        a, b = x / size, centres / size
        return pa.array(((b * b).sum(1)[None, :] - 2 * (a @ b.T)).argmin(1).astype(np.int32))

    placed = with_ordinal(rows.withColumn("cell", cell("vector")), ["label", "cell", "id"], "place")
    return placed.select("id", "label", "vector", "place", F.floor(F.col("place") / BLOCK).cast("bigint").alias("block"))


def index(rows: DataFrame, scale: float, leaf: int = LEAF) -> DataFrame:
    """(block, tree): the cover tree of each block."""

    def build(block: pa.Table) -> pa.Table:
        ids = block.column("id")
        made = Block(block.column("place").to_numpy(), ids.fill_null(0).to_numpy(), ~ids.is_null().to_numpy(),
                     block.column("label").to_numpy(), whole(block.column("vector").to_pylist(), scale), leaf)
        return pa.table({"block": block.column("block").slice(0, 1), "tree": pa.array([made.packed()], pa.binary())})

    return rows.groupBy("block").applyInArrow(build, "block bigint, tree binary")


FOUND = "place bigint, window int, other bigint, known boolean, other_place bigint, score bigint"
FOUND_ARROW = pa.schema([("place", pa.int64()), ("window", pa.int32()), ("other", pa.int64()), ("known", pa.bool_()),
                         ("other_place", pa.int64()), ("score", pa.int64())])


def searched(trees: DataFrame, cells: DataFrame, groups: int, count: int, same: bool, scale: float) -> DataFrame:
    """What the trees hold for anchors (block, part, place, label, vector, windows): the best ``count`` rows a window, of
    the anchor's own label and not itself, or of other labels."""

    def run(tree: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if tree.num_rows and anchors.num_rows:
            block = Block.unpacked(tree.column("tree")[0].as_py())
            vectors = fitted(whole(anchors.column("vector").to_pylist(), scale), block.rows.shape[1])
            for place, label, q, windows in zip(anchors.column("place").to_pylist(), anchors.column("label").to_pylist(), vectors,
                                                anchors.column("windows").to_pylist()):
                allowed = (block.labels == label) & (block.places != place) if same else block.labels != label
                if allowed.any():
                    for w, rows in enumerate(block.best(q, [(x["low"], x["high"]) for x in windows], count, allowed)):
                        out += [(place, w, i, not unknown, at, -s) for s, unknown, i, at in rows]
        columns = list(zip(*out)) or [[]] * len(FOUND_ARROW)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND_ARROW)], schema=FOUND_ARROW)

    copies = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return copies.groupBy("block", "part").cogroup(cells.groupBy("block", "part")).applyInArrow(run, FOUND)


def first_of(found: DataFrame, count: int) -> DataFrame:
    return top_k(found, ["place", "window"], [F.desc("score"), F.desc("known"), F.asc("other"), F.asc("other_place")], count)


def mined(df: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5,
          negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0, leaf: int = LEAF) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for the rows for which ``anchors``
    (of the column ``id``) holds and each of their first ``positives`` rows of the same label, the first ``negatives``
    rows of other labels whose score is between ``low`` and ``high`` hundredths of the positive's."""
    work = Workspace(df.sparkSession)
    rows = work.store(numbered(taking_part(df, key, vector, label), scale), "vectors")
    trees = work.store(index(rows, scale, leaf), "cover-trees")
    asked = rows.where(anchors).select("place", "id", "label", "vector")
    groups = max(1, -(-asked.count() // GROUP))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("place"), F.lit(groups)).cast("int"))
    # an anchor's positives lie in the blocks of its label
    held = rows.select("label", "block").distinct()
    everything = F.array(F.struct(F.lit(ENDS[0]).cast("bigint").alias("low"), F.lit(ENDS[1]).cast("bigint").alias("high"))).alias("windows")
    near = fan_out_join(asked, held, ["label"], ["place"]).select("block", "part", "place", "label", "vector", everything)
    first = work.store(first_of(searched(trees, near, groups, positives, True, scale), positives).select(
        "place", F.col("rank").alias("nth"), F.when(F.col("known"), F.col("other")).alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # whole numbers between the two shares of a score
    p = F.col("positive_score").cast("decimal(20,0)")
    window = F.struct("nth", F.ceil(p * low / 100).cast("bigint").alias("low"), F.floor(p * high / 100).cast("bigint").alias("high"))
    windows = first.groupBy("place").agg(F.array_sort(F.collect_list(window)).alias("windows"))
    count = F.lit(rows.agg(F.max("block").alias("b")).first()["b"] or 0)
    far = (asked.join(windows, "place").select(F.explode(F.sequence(F.lit(0).cast("bigint"), count.cast("bigint"))).alias("block"),
                                               "part", "place", "label", "vector", "windows"))
    others = first_of(searched(trees, far, groups, negatives, False, scale), negatives).withColumn("nth", F.col("window") + 1)
    return (others.join(first, ["place", "nth"]).join(asked.select("place", F.col("id").alias("anchor_id")), "place")
            .select("anchor_id", "positive_id", "rank", F.when(F.col("known"), F.col("other")).alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
