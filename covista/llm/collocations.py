"""Phrase collocations from count streams kept in prefix and in suffix order.

Counting: a pass over the texts counts words and pairs of words, a second one phrases of three and four, of which
every pair is frequent (a phrase is never more frequent than a part of it). Tasks count a few megabytes of text at a
time, so partial counts are what moves. A filter of fixed size tells the second pass which pairs to go on with.

Estimating: the frequent phrases, each with its count, are sorted twice, word by word from the front (prefix order)
and from the back (suffix order). In prefix order a phrase follows its own beginnings, in suffix order its own ends.
Reading a stream once with the path of open beginnings in hand therefore gives every phrase the counts of all its left
(or right) parts, and tells a phrase when one more word behind (or before) it is nearly as frequent. A path that is
open where one task's share of a sorted stream ends is handed to the tasks after it: four rows a task. The two streams
are then merge-joined phrase by phrase; no table of phrases is looked up anywhere.

Null texts are empty, null languages are ``und``. Repeated rows count as often as they occur. Ties in a rank go to the
more frequent phrase, then to the smaller one in byte order; a table without rows, or without a frequent phrase, gives
no rows. Columns but text and language are not read. A text is held whole by its task, and counted piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.llm import filters
from covista.plans import Workspace, shared_dir, spread, top_k

LONGEST = 4
SCALE = 2_000_000
# text that a task counts at a time
CHUNK_BYTES = 3 << 20
FILTER_BITS = 26
FACTOR = np.uint64(0x9E3779B97F4A7C15)
COUNTED = "lang string, size int, phrase string, n bigint"
ARROW = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])

# lower case for A-Z; what ends a piece becomes a comma, a tab becomes a space
TABLE = bytes(44 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def chunks(texts: Iterable[bytes], size: int) -> Iterator[bytes]:
    """Texts as runs of pieces of about ``size`` bytes, cut between pieces only."""
    held, length = [], 0
    for t in texts:
        t = t.translate(TABLE)
        while len(t) > size:
            cut = t.find(b",", size)
            if cut < 0:
                break
            yield t[:cut]
            t = t[cut + 1:]
        held.append(t)
        length += len(t)
        if length >= size:
            yield b",".join(held)
            held, length = [], 0
    if held:
        yield b",".join(held)


class Words:
    """The words of a chunk as numbers, with 0 between pieces."""

    def __init__(self, chunk: bytes):
        coded = pa.array([b",", *chunk.replace(b",", b" , ").split()], pa.binary()).dictionary_encode()
        self.words = coded.dictionary.cast(pa.string())
        self.codes = coded.indices.to_numpy()[1:].astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and second word of each different pair, their counts, and the pair at each place (-1: none)."""
        inside = (self.codes[:-1] > 0) & (self.codes[1:] > 0)
        at = np.nonzero(inside)[0]
        kinds, which, counts = np.unique(self.codes[at] << 32 | self.codes[at + 1], return_inverse=True, return_counts=True)
        placed = np.full(len(self.codes), -1, dtype=np.int64)
        placed[at] = which
        return kinds >> 32, kinds & 0xFFFFFFFF, counts, placed


def hashes_of(lang: str, first: list[bytes], second: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each pair of words."""
    seed = xxhash.xxh64_intdigest(lang.encode()) & 0xFFFFFFFF
    one = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in first), dtype=np.uint64, count=len(first))
    two = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in second), dtype=np.uint64, count=len(second))
    return mixed(one, two)


def mixed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    h = (one ^ (two * FACTOR)) * FACTOR
    h ^= h >> np.uint64(31)
    h *= FACTOR
    return h ^ (h >> np.uint64(29))


def counted(lang: str, size: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(counts)), pa.repeat(pa.scalar(size, pa.int32()), len(counts)),
                                       phrases, pa.array(counts.astype(np.int64))], schema=ARROW)


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, Iterator[bytes]]]:
    lang = batch.column("lang").fill_null("und")
    texts = batch.column("text").fill_null("").cast(pa.binary())
    for name in pc.unique(lang):
        rows = np.nonzero(pc.equal(lang, name).to_numpy(zero_copy_only=False))[0]
        yield name.as_py(), (texts[int(i)].as_py() for i in rows)


def joined(words: pa.Array, *codes: np.ndarray) -> pa.Array:
    return pc.binary_join_element_wise(*[words.take(pa.array(c)) for c in codes], " ")


def short_counts(docs: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """(lang, size, phrase, n): partial counts of words and pairs, and of all words as the phrase of size 0."""

    def run(batches):
        for batch in batches:
            for lang, texts in by_language(batch):
                for piece in chunks(texts, chunk):
                    found = Words(piece)
                    total = np.bincount(found.codes, minlength=len(found.words))[1:]
                    yield counted(lang, 0, pa.array([""]), np.array([total.sum()]))
                    yield counted(lang, 1, found.words[1:], total)
                    first, second, counts, _ = found.pairs()
                    for at in range(0, len(counts), 1 << 17):
                        part = slice(at, at + (1 << 17))
                        yield counted(lang, 2, joined(found.words, first[part], second[part]), counts[part])

    return docs.select("lang", "text").mapInArrow(run, COUNTED)


def long_counts(docs: DataFrame, pairs: np.ndarray, chunk: int = CHUNK_BYTES) -> DataFrame:
    """(lang, size, phrase, n): partial counts of phrases of 3 and 4 words all of whose pairs pass the filter."""
    sent = docs.sparkSession.sparkContext.broadcast(pairs)

    def run(batches):
        for batch in batches:
            for lang, texts in by_language(batch):
                for piece in chunks(texts, chunk):
                    found = Words(piece)
                    first, second, counts, placed = found.pairs()
                    seed = xxhash.xxh64_intdigest(lang.encode()) & 0xFFFFFFFF
                    own = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in found.words.cast(pa.binary()).to_pylist()),
                                      dtype=np.uint64, count=len(found.words))
                    good = np.append(filters.passes(sent.value, mixed(own[first], own[second])), False)[placed]
                    for size in range(3, LONGEST + 1):
                        n = len(placed) - size + 2
                        if n <= 0:
                            continue
                        at = np.nonzero(np.logical_and.reduce([good[k:n + k] for k in range(size - 1)]))[0]
                        # a phrase of 3 or 4 words is told by its first and its last pair
                        kinds, counts = np.unique(placed[at] << 32 | placed[at + size - 2], return_counts=True)
                        head, tail = kinds >> 32, kinds & 0xFFFFFFFF
                        words = [first[head], second[head], *([first[tail]] if size == 4 else []), second[tail]]
                        if len(kinds):
                            yield counted(lang, size, joined(found.words, *words), counts)

    return docs.select("lang", "text").mapInArrow(run, COUNTED)


def summed(partial: DataFrame, least: int) -> DataFrame:
    """Whole counts of phrases that occur ``least`` times, and the number of all words."""
    return partial.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("size") == 0))


def pair_filter(pairs: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    @F.arrow_udf("bigint")
    def hashed(langs: pa.Array, phrases: pa.Array) -> pa.Array:
        out = [hashes_of(lang, [a], [b])[0] for lang, (a, b) in zip(langs.to_pylist(), (p.encode().split(b" ") for p in phrases.to_pylist()))]
        return pa.array(np.array(out, dtype=np.uint64).view(np.int64))

    return filters.built(pairs.select(hashed("lang", "phrase").alias("h")), "h", bits)


def frequent_phrases(docs: DataFrame, least: int, work: Workspace, bits: int = FILTER_BITS, chunk: int = CHUNK_BYTES) -> DataFrame:
    """(lang, size, phrase, n) of all phrases of up to four words that occur ``least`` times or more, and the words
    of each language as the phrase of size 0."""
    short = work.store(summed(short_counts(docs, chunk), least), "short-phrases")
    long = work.store(summed(long_counts(docs, pair_filter(short.where("size = 2"), bits), chunk), least), "long-phrases")
    return short.unionByName(long)


# a phrase's parts by number of words, as read from a stream; covered: the phrase that one more word makes hardly rarer
READ = "lang string, size int, phrase string, n bigint, parts array<bigint>, covered string"
OPEN = "lang string, phrase array<string>, n bigint"


def in_order(phrases: DataFrame, backwards: bool) -> DataFrame:
    """The stream (lang, words, n) in prefix order, or with words turned round: in suffix order.

    Checkpointed, so that a lost task can't move rows from one share to another.
    """
    shared_dir(phrases.sparkSession)
    words = F.split("phrase", " ")
    stream = phrases.where("size > 0").select("lang", (F.reverse(words) if backwards else words).alias("words"), "n")
    sort = ["lang", "words"]
    return stream.repartitionByRange(spread(phrases), *sort).sortWithinPartitions(*sort).checkpoint()


def open_paths(stream: DataFrame) -> list:
    """The beginnings that are open where each task's share of a stream ends: at most four rows a task."""

    def run(batches):
        lang, path = None, []
        for batch in batches:
            for name, words, n in zip(*[batch.column(c).to_pylist() for c in ("lang", "words", "n")]):
                if name != lang:
                    lang, path = name, []
                while path and path[-1][0] != words[:len(path[-1][0])]:
                    path.pop()
                path.append((words, n))
        if path:
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(path)), pa.array([w for w, _ in path], pa.list_(pa.string())),
                                              pa.array([n for _, n in path], pa.int64())], ["lang", "phrase", "n"])

    return stream.mapInArrow(run, OPEN).collect()


def read_stream(stream: DataFrame, backwards: bool, cover: tuple[int, int]) -> DataFrame:
    """One pass over a sorted stream: for each phrase of two words or more the counts of its beginnings (of the
    turned words), and for each phrase that one more word makes hardly rarer its own text."""
    share, whole = cover
    opened = {(row["lang"], tuple(row["phrase"])): row["n"] for row in open_paths(stream)}

    def text(words: list[str]) -> str:
        return " ".join(reversed(words) if backwards else words)

    def run(batches):
        lang, path = None, []
        for batch in batches:
            out = {k: [] for k in ("lang", "size", "phrase", "n", "parts", "covered")}
            for name, words, n in zip(*[batch.column(c).to_pylist() for c in ("lang", "words", "n")]):
                if name != lang:
                    lang, path = name, []
                # every beginning of a frequent phrase is frequent and stands before it: on the path, or open at
                # the end of an earlier share
                keep = 0
                while keep < len(path) and keep < len(words) and path[keep][0] == words[:keep + 1]:
                    keep += 1
                del path[keep:]
                for k in range(keep + 1, len(words)):
                    path.append((words[:k], opened[(lang, tuple(words[:k]))]))
                if len(words) > 1:
                    parent, above = path[-1]
                    covered = text(parent) if len(parent) > 1 and whole * n >= share * above else None
                    for key, value in (("lang", lang), ("size", len(words)), ("phrase", text(words)), ("n", n),
                                       ("parts", [c for _, c in path]), ("covered", covered)):
                        out[key].append(value)
                path.append((words, n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["lang"], pa.string()), pa.array(out["size"], pa.int32()), pa.array(out["phrase"], pa.string()),
                 pa.array(out["n"], pa.int64()), pa.array(out["parts"], pa.list_(pa.int64())), pa.array(out["covered"], pa.string())],
                ["lang", "size", "phrase", "n", "parts", "covered"])

    return stream.mapInArrow(run, READ)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE a / (l + r)), exact beyond 64 bits."""
    wide = "decimal(38,0)"
    top = a.cast("decimal(20,0)").cast(wide) * F.lit(SCALE).cast("decimal(8,0)")
    return F.call_function("div", top.cast(wide), (left.cast("decimal(20,0)") + right.cast("decimal(20,0)")).cast(wide)).cast("bigint")


def collocations(docs: DataFrame, least: int = 30, best: int = 2000, cover: tuple[int, int] = (80, 100),
                 lang: str = "lang", text: str = "text", bits: int = FILTER_BITS, chunk: int = CHUNK_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to 4 words.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of the language.
    A phrase is left out where one that holds it is at least ``cover`` as frequent: it is enough to look at one
    more word, since what lies between the two is at least as frequent as the longer one.
    """
    work = Workspace(docs.sparkSession)
    phrases = frequent_phrases(docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")), least, work, bits, chunk)
    ahead = work.store(read_stream(in_order(phrases, False), False, cover), "prefix-order")
    back = work.store(read_stream(in_order(phrases, True), True, cover), "suffix-order")
    covered = ahead.select("lang", "covered").unionByName(back.select("lang", "covered")).where("covered is not null")
    both = (ahead.select("lang", "phrase", "size", F.col("n").alias("a"), F.col("parts").alias("lefts"))
            .join(back.select("lang", "phrase", F.col("parts").alias("rights")).hint("merge"), ["lang", "phrase"])
            .join(covered.select("lang", F.col("covered").alias("phrase")).hint("merge"), ["lang", "phrase"], "left_anti"))
    # the part after the first k words is the end of size - k words
    cuts = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        score(F.col("a"), F.get("lefts", k - 1), F.get("rights", F.col("size") - k - 1)).alias("score"), k.alias("k"),
        F.get("lefts", k - 1).alias("l"), F.get("rights", F.col("size") - k - 1).alias("r")))
    scored = both.select("lang", "phrase", "a", F.array_min(cuts).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    first = top_k(scored, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], best)
    sizes = phrases.where("size = 0").select("lang", F.col("n"))
    return first.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
