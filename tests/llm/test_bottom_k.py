"""Near duplicates by bottom-k sketches against all pairs, and the components of edges."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from covista.llm import bottom_k
from covista.llm.queries import QUERIES
from covista.plans import Workspace, components
from covista.plans.components import forest
from tests.llm.brute import WORDS

FOLDER = "/root/testdata/sf0.001"


def shingles(text, size=5):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain(rows, percent=85):
    """(id, n_shingles, component_id, kept) of all rows, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    out = []
    for i, (key, _) in enumerate(rows):
        if sets[i]:
            low = min((rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None), default=None)
        else:
            low = key
        out.append((key, len(sets[i]), low, key is not None and key == low))
    return sorted(out, key=str)


def found(df, **options):
    return sorted((tuple(r) for r in bottom_k.near_duplicates(df, **options).collect()), key=str)


def changed(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def copies(rng, first=0):
    """Texts around the threshold: groups of a long and a short original, chains of small edits, common passages."""
    texts = []
    for group in range(6):
        words = [f"g{group}w{i}" for i in range(rng.choice([12, 60, 300]))]
        texts += [changed(rng, words, rng.randrange(0, 1 + len(words) // 30)) for _ in range(14)]
    chain = [f"c{i}" for i in range(120)]
    for i in range(12):
        texts.append(" ".join(chain))
        chain = chain[1:] + [f"d{i}"]
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} {' '.join(f't{i}x{k}' for k in range(rng.choice([5, 8, 40])))}" for i in range(40)]
    return [(first + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("k, block, percent", [(64, 256, 85), (64, 4, 85), (16, 3, 85), (32, 8, 60), (64, 5, 100)])
def test_components_equal_those_of_all_pairs(spark, monkeypatch, k, block, percent):
    monkeypatch.setattr(bottom_k, "BLOCK", block)
    rows = copies(random.Random(k + block))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df, percent=percent, k=k) == plain(rows, percent)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(3, None), (1, ""), (2, " \t\n"), (9, "One two"), (4, "one TWO"), (None, "one two"), (None, None), (5, "two one"), (9, "one\x0btwo"),
            (20, long), (21, long + " more"), (7, "a a a a a a a"), (6, "a a a a a"), (8, "É a b c d"), (10, "é a b c d"), (None, "alone in null")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "1 AS n", "2 AS key", "3 AS id", "4 AS value", "5 AS root", "6 AS digest", "7 AS words")
    assert found(df) == plain(rows)
    assert found(df.limit(0)) == []


def test_large_group_of_near_copies(spark, monkeypatch):
    """One group over many blocks of each list, with common values."""
    monkeypatch.setattr(bottom_k, "BLOCK", 32)
    rng = random.Random(4)
    words = [f"h{i}" for i in range(150)]
    rows = [(i, changed(rng, words, 1)) for i in range(400)] + [(1000 + i, changed(rng, words, 12)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df) == plain(rows)


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op13_bottom_k"](spark, FOLDER).collect()), key=str) == plain(rows)


def test_least_shared_bounds_the_chance():
    for k in (16, 32, 64, 128):
        c = bottom_k.least_shared(k, 85)
        missed = sum(math.comb(k, i) * 0.85 ** i * 0.15 ** (k - i) for i in range(c))
        assert missed <= bottom_k.MISS and 0 < c < 0.85 * k
    assert bottom_k.least_shared(64, 100) == 64


def test_forest_connects_what_edges_connect():
    a, b = forest(np.array([5, 7, 1, 9, 9]), np.array([3, 5, 2, 9, 8]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(1, 2), (3, 5), (3, 7), (8, 9)]


def test_components_with_a_hub(spark):
    edges = [(10_000, i) for i in range(3000)] + [(20_000, 20_001), (20_001, 20_002), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), Workspace(spark)).collect()}
    assert got == {**{i: 0 for i in range(3000)}, 10_000: 0, 20_000: 20_000, 20_001: 20_000, 20_002: 20_000}


def test_words_of_few_texts_are_held():
    columns = [pa.array([f"a {i}" for i in range(n)]) for n in (300, 0, 5)]
    cut = list(bottom_k.pieces(iter(columns)))
    assert max(map(len, cut)) <= 128 and [t for c in cut for t in c.to_pylist()] == [t for c in columns for t in c.to_pylist()]
