"""Near duplicates by 64-bit SimHash, found through a Golay code.

The (23, 12) Golay code is perfect: every 23-bit word lies within 3 bits of exactly one of 4,096
codewords. A fingerprint is cut in segments of 23, 23 and 18 bits. An entry names a segment by its
codeword; a probe names it by all codewords within 4 bits, about five, and so meets every entry whose
segment differs in at most one bit. Three differing bits fall on three segments so that either one segment
is the same and another differs by at most one bit, or all differ by exactly one. For the former, keys are
a segment's codeword with another segment as it is (six kinds). For the latter they are the codewords of the first
two segments with the parities of all three, which a probe turns round. Pairs that meet are verified by
their bit distance.

Equal fingerprints are one node. Fingerprints that meet at one key are cut in blocks whose pairs are
compared in vectors; a block pair hands on a forest of its links, so dense groups of near copies never
become lists of all pairs, and no link between components is lost.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.plans import Workspace, components
from covista.plans import spread as spread_of

# Generator of the Golay code x^11+x^10+x^6+x^5+x^4+x^2+1; segment starts and widths.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))
HASH_SEED = 42
KIND = 40
# fingerprints of one key that are compared in one piece
BLOCK = 2048


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of the shingles of a text, A-Z lower-cased: a bit is 1 if set in over half the hashes."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(line, HASH_SEED)]
    else:
        ends, at = [], -1
        for p in parts:
            at += len(p) + 1
            ends.append(at)
        starts = [0, *[e + 1 for e in ends[:len(parts) - words]]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], HASH_SEED) for a, b in zip(starts, ends[words - 1:])]
    return majority(np.array(hashes, dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, words: int = 3) -> Column:
    """Fingerprint of a text as a long (two's complement). No words: zero."""

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        made = np.fromiter((fingerprint(t.as_py(), words) for t in texts), dtype=np.uint64, count=len(texts))
        return pa.array(made.view(np.int64))

    return run(text)


@lru_cache(maxsize=1)
def codewords_near() -> tuple[np.ndarray, np.ndarray]:
    """For every 23-bit word: its codeword's index, and the indices within 4 bits (-1: no more).

    A word at 4 bits from a codeword becomes one at 3 bits by a single flip, so the codewords
    within 4 bits are those of the word and its 23 neighbours.
    """
    index = np.full(1 << 23, -1, dtype=np.int16)
    words = np.zeros(1, dtype=np.uint32)
    for bit in range(12):
        words = np.concatenate([words, words ^ np.uint32(GENERATOR << bit)])
    order = np.arange(len(words), dtype=np.int16)
    errors = [0] + [sum(1 << b for b in bits) for n in (1, 2, 3) for bits in combinations(range(23), n)]
    for e in errors:
        index[words ^ np.uint32(e)] = order
    return index, words


def near(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords within 4 bits of each word, repeated ones included: 24 columns."""
    index, _ = codewords_near()
    flips = np.array([0] + [1 << b for b in range(23)], dtype=np.uint32)
    return np.sort(index[words.astype(np.uint32)[:, None] ^ flips[None, :]], axis=1)


def _pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, left and right value of each combination of two lists per row."""
    fresh_l = np.concatenate([np.ones((len(left), 1), bool), left[:, 1:] != left[:, :-1]], axis=1)
    fresh_r = np.concatenate([np.ones((len(right), 1), bool), right[:, 1:] != right[:, :-1]], axis=1)
    row, i, j = np.nonzero(fresh_l[:, :, None] & fresh_r[:, None, :])
    return row, left[row, i], right[row, j]


def keys_of(prints: np.ndarray) -> pd.DataFrame:
    """Entries and probes of fingerprints: key, fingerprint, probe."""
    index, _ = codewords_near()
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]
    own = [index[p].astype(np.int64) for p in parts]
    close = [near(p) for p in parts]
    odd = sum((np.bitwise_count(p).astype(np.int64) & 1) << i for i, p in enumerate(parts))
    row, x, y = _pairs(close[0], close[1])
    everyone = np.arange(len(prints))
    made = [(everyone, (own[0] << 15) | (own[1] << 3) | odd, False),
            (row, (x.astype(np.int64) << 15) | (y.astype(np.int64) << 3) | (odd[row] ^ 7), True)]
    for kind, (a, b) in enumerate(permutations(range(3), 2), 1):
        fresh = np.concatenate([np.ones((len(prints), 1), bool), close[a][:, 1:] != close[a][:, :-1]], axis=1)
        row, at = np.nonzero(fresh)
        head = kind << KIND
        made += [(everyone, head | (own[a] << 23) | parts[b], False),
                 (row, head | (close[a][row, at].astype(np.int64) << 23) | parts[b][row], True)]
    return pd.concat([pd.DataFrame({"key": key, "print": prints[rows].view(np.int64), "probe": probe})
                      for rows, key, probe in made], ignore_index=True)


def _keyed(batches):
    for batch in batches:
        prints = batch["print"].to_numpy().view(np.uint64)
        for at in range(0, len(prints), 1024):
            yield keys_of(prints[at:at + 1024])


def forest(a: np.ndarray, b: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs of the two lists within ``distance`` bits connect: at most one
    fewer than there are fingerprints."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    for at in range(0, len(a), 256):
        part = a[at:at + 256]
        apart = np.bitwise_count(part[:, None] ^ b[None, :])
        for i, j in zip(*np.nonzero(apart <= distance)):
            x, y = int(part[i]), int(b[j])
            if x != y and (u := root(x)) != (v := root(y)):
                parent[u] = v
                out.append((x, y))
    made = np.array(out, dtype=np.uint64).reshape(-1, 2)
    return made[:, 0], made[:, 1]


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``print``) that connect exactly what all
    pairs within ``distance`` (3 at most) bits connect.

    The entries of a key are collected in blocks of bounded size and met by blocks of its probes.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the code covers distances up to 3")
    # a print makes some sixty keys, so prints are spread first
    keyed = prints.repartition(spread_of(prints), "print").mapInPandas(_keyed, "key bigint, print bigint, probe boolean")
    spread = F.pmod(F.xxhash64("print"), F.lit(1 << 16))
    sizes = keyed.groupBy("key").agg(F.count_if(~F.col("probe")).alias("entries"), F.count_if("probe").alias("probes"))
    # an entry that meets no probe but its own, which only the kinds after the first have, links nothing
    others = F.col("probes") >= F.when(F.col("key") < 1 << KIND, 1).otherwise(2)
    busy = sizes.where((F.col("entries") >= 1) & others).select(
        "key", F.ceil(F.col("entries") / BLOCK).cast("int").alias("cuts"), F.ceil(F.col("probes") / BLOCK).cast("int").alias("rows"))
    # merged: Spark takes the keys for a few bytes a print and would send them all through the driver
    met = keyed.join(busy.hint("merge"), "key")
    cells = met.select("key", "print", "probe", F.explode(F.when(
        F.col("probe"), F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda c: c + F.col("cuts") * F.pmod(spread, F.col("rows"))))
        .otherwise(F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda r: r * F.col("cuts") + F.pmod(spread, F.col("cuts"))))
    ).alias("cell"))
    blocks = cells.groupBy("key", "cell").agg(
        F.collect_list(F.when(~F.col("probe"), F.col("print"))).alias("entries"),
        F.collect_list(F.when(F.col("probe"), F.col("print"))).alias("probes")).where(
        (F.size("entries") > 0) & (F.size("probes") > 0))

    def compared(batches):
        for batch in batches:
            for e, p in zip(batch["entries"], batch["probes"]):
                x, y = forest(np.asarray(p, dtype=np.int64).view(np.uint64), np.asarray(e, dtype=np.int64).view(np.uint64), distance)
                if len(x):
                    yield pd.DataFrame({"a": np.minimum(x.view(np.int64), y.view(np.int64)), "b": np.maximum(x.view(np.int64), y.view(np.int64))})

    return blocks.select("entries", "probes").mapInPandas(compared, "a bigint, b bigint").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, distance: int = 3) -> DataFrame:
    """(key, fingerprint, component_id) per row of ``df``.

    ``component_id`` is the smallest key among the rows reachable by links, own row included; null
    keys don't count (a component of null keys has none). Texts without words have fingerprint zero.
    Rows with equal keys are rows of their own.
    """
    work = Workspace(df.sparkSession)
    rows = work.store(df.select(F.col(key).alias("key"), fingerprints(F.col(text), words).alias("print")), "prints")
    firsts = work.store(rows.groupBy("print").agg(F.min("key").alias("first")), "firsts")
    roots = work.store(components(links(firsts.select("print"), distance), work), "roots")
    placed = firsts.join(roots, firsts["print"] == roots["node"], "left").withColumn("root", F.coalesce("root", "print"))
    lowest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = placed.join(lowest, "root").select(F.col("print").alias("_print"), "component_id")
    return (rows.join(of_print, rows["print"] == of_print["_print"])
            .select(F.col("key").alias(key), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"))
