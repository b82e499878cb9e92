"""Hard negatives and their cover trees against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from covista.llm import hard_negatives
from covista.llm.queries import QUERIES


def plain(rows, anchor, positives=5, negatives=5, low=80, high=100, scale=256):
    """rows: (id, vector, label); sorted result rows."""
    good = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    def place(s, i):
        return (-s, i is None, i or 0)

    out = []
    for k, (i, v, label) in enumerate(good):
        if i is None or not anchor(i):
            continue
        same = sorted(place(score(v, w), j) for n, (j, w, other) in enumerate(good) if other == label and n != k)[:positives]
        rest = sorted(place(score(v, w), j) for j, w, other in good if other != label)
        for minus, gone, j in same:
            found = [x for x in rest if -low * minus <= -100 * x[0] <= -high * minus][:negatives]
            out += [(i, None if gone else j, r, None if g else n, -minus, -s) for r, (s, g, n) in enumerate(found, 1)]
    return sorted(out, key=str)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    return df.selectExpr("*", "1 AS place", "2 AS block", "3 AS id", "4 AS windows", "5 AS vector", "6 AS cell", "7 AS nth")


def found(df, **options):
    return sorted((tuple(r) for r in hard_negatives.mined(df, F.col("id") % 4 == 0, leaf=3, **options).collect()), key=str)


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("BLOCK", 32), ("GROUP", 8), ("PIVOTS", 4)):
        monkeypatch.setattr(hard_negatives, name, value)


def test_mined_rows(spark, small_blocks):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(int(i), (centres[i % 6] * rng.uniform(0.5, 2) + 0.3 * rng.normal(size=8)).astype(np.float32).tolist(), int(rng.integers(0, 3)))
            for i in range(150)]
    rows += [(200 + i, [1.0] * 8, i % 2) for i in range(60)]  # a common vector
    rows += [(300, None, 1), (304, [1.0, None, 2.0], 1), (308, [float("nan")] * 8, 1), (312, [float("inf")] * 8, 0), (316, [1.0] * 8, None),
             (320, [], 1), (324, [2.0, 1.0], 0), (328, [0.5] * 12, 1), (None, [1.0] * 8, 1), (None, [0.9] * 8, 0), (332, [0.0] * 8, 0),
             (336, [1.0, -1.0] * 4, 9), (4, rows[4][1], 2), (4, rows[4][1], rows[4][2])]
    assert found(frame(spark, rows)) == plain(rows, lambda i: i % 4 == 0)
    assert found(frame(spark, rows), positives=2, negatives=3, low=50, high=120) == plain(rows, lambda i: i % 4 == 0, 2, 3, 50, 120)


def test_products_of_very_large_components(spark, small_blocks):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.normal(size=3) * 2.0 ** 20).astype(np.float32).tolist(), int(i % 2)) for i in range(80)]
    assert found(frame(spark, rows)) == plain(rows, lambda i: i % 4 == 0)
    huge = [(i, [3e38, float(i)], i % 2) for i in range(9)]
    assert {r[4] for r in found(frame(spark, huge))} == {(1 << 63) - 1}


def test_no_rows_and_one_label(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(i, [1.0], 1) for i in range(9)])) == []


def test_bounds_hold_and_prune():
    """Every row's product lies within the bounds of all nodes above it; far clusters are not visited."""
    rng = np.random.default_rng(5)
    rows = np.floor(256 * (np.repeat(rng.normal(size=(16, 8)), 64, 0) + 0.02 * rng.normal(size=(1024, 8))))
    n = len(rows)
    block = hard_negatives.Block(np.arange(n), np.arange(n), np.ones(n, bool), np.zeros(n, np.int64), rows, 16)
    again = hard_negatives.Block.unpacked(block.packed())

    def leaves(i):
        return [again.tree.leaves[i]] if i in again.tree.leaves else [x for c in again.tree.children[i] for x in leaves(c)]

    for q in rows[::100]:
        least, most = again.tree.bounds(q)
        for i in range(len(least)):
            for a, b in leaves(i):
                scores = hard_negatives.products(again.rows[a:b], q)
                assert (scores >= least[i]).all() and (scores <= most[i]).all()
        visited = []
        got = again.best(q, [(-(1 << 63), (1 << 63) - 1)], 5, np.ones(n, bool), visited)[0]
        want = sorted((-int(s), False, int(i), int(i)) for i, s in enumerate(hard_negatives.products(rows, q)))[:5]
        assert got == want and sum(visited) < n / 4


def test_levels_cover_within_their_radius():
    rng = np.random.default_rng(6)
    tree = hard_negatives.CoverTree(rng.normal(size=(500, 5)), leaf=2)
    assert sorted(tree.order.tolist()) == list(range(500))
    for i, children in enumerate(tree.children):
        assert all(tree.node_angle[c] <= tree.node_angle[i] + 2 * math.pi for c in children)
    assert sum(b - a for a, b in tree.leaves.values()) == 500


def test_query_takes_relabelled_rows(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], list(r["embedding"]), (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_hard_negatives"](spark, folder).collect()), key=str)
    assert got == plain(rows, lambda i: i % 100 == 0)
