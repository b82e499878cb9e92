"""Repeated substrings, level by level with windows of doubled length.

A window of ``size`` words is stood for by one of its parts at every level: the part of 9 words, then of
18, whose hash is smallest (leftmost first), at last the window itself. Equal windows have equal parts,
so a window whose part occurs once is unique and is not looked at again; those that are left are taken to
twice the length, until none is left or the full length is reached. Parts are chosen by content, so the
first level moves about 7 hashes per 100 words, not 100.

Texts move once, and only those with windows left move again. Of texts with the same words one stands for
all, with the rest being known to repeat. Windows are compared by 64-bit hashes of the hashes of their
words. A text is held whole by the task that reads it.

Null and empty texts have no words. Rows are judged one by one: repeated rows are copies of each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.plans import Workspace

FACTOR = np.uint64(0x9E3779B97F4A7C15)
FIRST_PARTS = 4


def levels(size: int) -> list[int]:
    """Lengths of the parts: a quarter of the window (rounded up), doubled up to the window."""
    out = [max(1, -(-size // FIRST_PARTS))]
    while out[-1] < size:
        out.append(min(size, 2 * out[-1]))
    return out


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def parts(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive words."""
    n = len(h) - length + 1
    out = h[:n].copy()
    for k in range(1, length):
        out *= FACTOR
        out += h[k:k + n]
    return out ^ (out >> np.uint64(29))


def smallest(g: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest (leftmost) of every ``span`` consecutive values."""
    value, place, width = g, np.arange(len(g)), 1
    while width < span:
        step = min(width, span - width)
        less = value[step:] < value[:-step]
        value = np.where(less, value[step:], value[:-step])
        place = np.where(less, place[step:], place[:-step])
        width += step
    return place


def survivors(h: np.ndarray, size: int, length: int | None, live) -> np.ndarray:
    """Windows whose part of ``length`` words is among ``live``; all at the first level."""
    n = len(h) - size + 1
    if length is None:
        return np.arange(n)
    g = parts(h, length)
    known = np.asarray(live, dtype=np.int64).view(np.uint64)
    return np.nonzero(np.isin(g, known)[smallest(g, size - length + 1)])[0]


def emitted(h: np.ndarray, size: int, alive: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the parts that stand for the windows, each place once."""
    g = parts(h, length)
    return g[np.unique(smallest(g, size - length + 1)[alive])].view(np.int64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int64, copy=False)))


NONE = np.empty(0, dtype=np.int64)


def first_level(rows: DataFrame, size: int) -> DataFrame:
    """(key, row, n_words, words_hash, hashes) from (key, row, text)."""
    length = levels(size)[0]

    def run(batches):
        for batch in batches:
            counts, digests, found = [], [], []
            for t in batch.column("text"):
                words = split(t.as_py())
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).digest())
                if len(words) < size:
                    found.append(NONE)
                else:
                    h = hashed(words)
                    found.append(emitted(h, size, survivors(h, size, None, None), length))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("row"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), _lists(found)],
                ["key", "row", "n_words", "words_hash", "hashes"])

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, row bigint, n_words bigint, "
                                "words_hash binary, hashes array<bigint>")


def next_level(texts: DataFrame, size: int, before: int, length: int) -> DataFrame:
    """(row, copied, hashes) from texts (row, copied, text, live)."""

    def run(batches):
        for batch in batches:
            found = []
            for t, live in zip(batch.column("text"), batch.column("live")):
                h = hashed(split(t.as_py()))
                alive = survivors(h, size, before, live.values) if len(h) >= size else NONE
                found.append(emitted(h, size, alive, length) if len(alive) else NONE)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("copied"), _lists(found)],
                                             ["row", "copied", "hashes"])

    return texts.select("row", "copied", "text", "live").mapInArrow(run, "row bigint, copied boolean, hashes array<bigint>")


def cut(texts: DataFrame, size: int) -> DataFrame:
    """(words_hash, n_removed, kept) from texts (words_hash, text, live): words outside live windows."""

    def run(batches):
        for batch in batches:
            keys, removed, kept = [], [], []
            for key, t, live in zip(batch.column("words_hash"), batch.column("text"), batch.column("live")):
                words = split(t.as_py())
                # two rows may share their number, but not the digest of their words
                if len(words) < size or hashlib.sha256(b" ".join(words)).digest() != key.as_py():
                    continue
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                starts = survivors(hashed(words), size, size, live.values)
                edge[starts] += 1
                edge[starts + size] -= 1
                stays = np.cumsum(edge[:-1]) == 0
                keys.append(key.as_py())
                removed.append(len(words) - int(stays.sum()))
                kept.append(b" ".join([w for w, s in zip(words, stays.tolist()) if s]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                                             ["words_hash", "n_removed", "kept"])

    return texts.select("words_hash", "text", "live").mapInArrow(run, "words_hash binary, n_removed bigint, kept binary")


def repeated(hashes: DataFrame, asked) -> DataFrame:
    """(row, live): of each row for which ``asked`` holds, the hashes that occur twice or more anywhere."""
    twice = (hashes.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("n"))
             .where("n > 1").select("hash"))
    mine = hashes.where(asked).select("row", F.explode(F.array_distinct("hashes")).alias("hash"))
    return mine.join(twice, "hash").groupBy("row").agg(F.collect_list("hash").alias("live"))


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 35) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) per row of ``df``: words covered by a window of ``size``
    words that also starts elsewhere are removed; the digest is that of the kept words, joined by a space.
    """
    work = Workspace(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), F.xxhash64(F.col(key), F.col(text)).alias("row"), F.col(text).alias("text"))
    first = work.store(first_level(rows, size), "first-level")
    copies = (first.groupBy(F.col("words_hash").alias("_words")).agg(F.count("*").alias("n"), F.min("key").alias("_first"))
              .where("n > 1").drop("n"))
    marked = work.store(first.join(copies, first["words_hash"] == copies["_words"], "left").select(
        "key", "row", "n_words", "words_hash", "hashes", F.col("_words").isNotNull().alias("copied"),
        (F.col("_words").isNull() | F.col("key").eqNullSafe(F.col("_first"))).alias("stands")), "marked")
    work.drop(first)

    standing = marked.where("stands")
    live = work.store(repeated(standing, F.lit(True)), "live")
    lengths = levels(size)
    chosen = standing.select("row", "copied", "words_hash").join(live, "row").withColumnRenamed("row", "_row")
    texts = work.store(rows.join(chosen, rows["row"] == chosen["_row"]).select(
        "row", "copied", "words_hash", "text", "live"), "texts")
    work.drop(live)
    now = texts
    for before, length in zip(lengths, lengths[1:]):
        hashes = work.store(next_level(now, size, before, length).where(F.size("hashes") > 0), "level")
        # at full length texts that repeat as a whole need no answer
        live = work.store(repeated(hashes, F.lit(True) if length < size else ~F.col("copied")), "live")
        work.drop(hashes)
        now = texts.drop("live").join(live, "row")
    done = now.where("not copied").transform(cut, size)
    done = done.select(F.col("words_hash").alias("_words"), "n_removed", F.sha2("kept", 256).alias("sha"))
    whole = F.col("copied") & (F.col("n_words") >= size)
    return (marked.drop("hashes").join(done, marked["words_hash"] == done["_words"], "left").select(
        F.col("key").alias(key), "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(
            F.coalesce("sha", F.lower(F.hex("words_hash")))).alias("kept_sha256")))
