"""Benchmark decontamination: BM25 with block-max WAND over test items, then a check of the overlap.

Test items are indexed in shards of bounded size; an index goes to every worker. Each training text is cut
in passages of twice the longest item, every half length, so some passage holds any item whole. A passage
is a query; items are scored by BM25 as a share of what they would score against themselves, and all above
the threshold are retrieved. Scores never depend on how items are dealt to shards: document frequencies
are counted over all items.

Before the search proper a bound is taken for whole runs of passages at once: the block maxima of the
rarer terms of a passage, summed per block of items, plus the most that the common terms could add. Of an
item that its common terms alone could bring to the threshold, the strongest count as rarer ones, so each
block above the threshold has a rarer term in the passage. Only passages with such a block are searched. A retrieved item counts as leaked if the
text around the passage holds enough of the word shingles of its question and of its answer.

Null and empty texts leak nothing; items without words are never found. Rows with the same id and text
count as one item. Texts under several ids are several items in all counts, but have one entry in an index;
a join gives the other ids.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.plans import fan_out_join, stored

K1, B = 1.2, 0.75
BLOCK = 4
# texts of one index
SHARD = 10_000
# of the items' score against themselves
THRESHOLD = 0.6
SHINGLE, OVERLAP = 5, 0.8
# terms in more than this share of the items are bounded by a constant, unless an item could be found by them alone
COMMON = 0.05
# for sums taken in another order
MARGIN = 1e-6

WORD = re.compile(r"\w+")
LEAKS = "array<struct<entry:binary,item_id:bigint,score:double,question_overlap:double,answer_overlap:double,at:int>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """Words of an item's question and answer: the answer is the last sentence, or the last quarter of
    an item of one sentence."""
    parts = [w for p in re.split(r"(?<=[.!?])\s+", (text or "").strip()) if (w := words_of(p))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """Five-word shingles; a shorter text is one shingle."""
    return {tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


def share(part: list[str], words: list[str]) -> float:
    """Share of a part's shingles that occur among the words."""
    wanted = shingles(part)
    size = min(SHINGLE, len(part))
    have = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
    return len(wanted & have) / len(wanted) if wanted else 1.0


@dataclass
class Item:
    item_id: int
    text: str
    frequencies: dict[str, int]  # items that have the term
    entry: bytes = b""  # digest of the text


class Index:
    """Postings by term with block maxima, for items of one shard."""

    def __init__(self, items: list[Item], n_items: int, mean_words: float, threshold: float = THRESHOLD):
        self.items = items
        self.parts = [question_and_answer(x.text) for x in items]
        self.postings: dict[str, list[tuple[int, float]]] = {}
        self.longest = 1
        for place, item in enumerate(items):
            words = words_of(item.text)
            self.longest = max(self.longest, len(words))
            counts: dict[str, int] = {}
            for w in words:
                counts[w] = counts.get(w, 0) + 1
            impact = {}
            for w, n in counts.items():
                df = item.frequencies[w]
                idf = math.log(1 + (n_items - df + 0.5) / (df + 0.5))
                impact[w] = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / mean_words))
            whole = sum(impact.values())
            for w, x in impact.items():
                self.postings.setdefault(w, []).append((place, x / whole))
        n_blocks = -(-len(items) // BLOCK)
        self.blocks = {w: self._maxima(p) for w, p in self.postings.items()}
        self.most = {w: max(x for _, x in p) for w, p in self.postings.items()}
        # rarer terms: block maxima in flat arrays, by number of the term; number 0 is any other word
        frequencies = {w: f for item in items for w, f in item.frequencies.items()}
        rare = [w for w in self.postings if frequencies[w] <= max(2, COMMON * n_items)]
        rare += self._needed(set(rare), threshold)
        self.number = {w: i for i, w in enumerate(rare, 1)}
        lists = [[]] + [sorted(self.blocks[w].items()) for w in rare]
        self.start = np.cumsum([0] + [len(x) for x in lists])
        self.block = np.array([b for x in lists for b, _ in x], dtype=np.int64)
        self.bound = np.array([m for x in lists for _, m in x], dtype=np.float64)
        rest = np.zeros(len(items))
        for w, p in self.postings.items():
            if w not in self.number:
                for place, x in p:
                    rest[place] += x
        self.rest = np.array([rest[b * BLOCK:(b + 1) * BLOCK].max() for b in range(n_blocks)])
        self.n_blocks = n_blocks

    def _needed(self, rare: set[str], threshold: float) -> list[str]:
        """Common terms without which no item's other common terms reach the threshold."""
        common: list[list[tuple[float, str]]] = [[] for _ in self.items]
        for w, p in self.postings.items():
            if w not in rare:
                for place, x in p:
                    common[place].append((x, w))
        out: dict[str, None] = {}
        for terms in common:
            rest = sum(x for x, w in terms if w not in out)
            for x, w in sorted(terms, reverse=True):
                if rest < threshold - MARGIN:
                    break
                if w not in out:
                    out[w] = None
                    rest -= x
        return list(out)

    @staticmethod
    def _maxima(postings: list[tuple[int, float]]) -> dict[int, float]:
        out: dict[int, float] = {}
        for place, x in postings:
            out[place // BLOCK] = max(out.get(place // BLOCK, 0.0), x)
        return out

    def promising(self, words: list[str], starts: np.ndarray, length: int, threshold: float) -> np.ndarray:
        """Starts of passages in which some block may reach the threshold."""
        if self.rest.max(initial=0.0) >= threshold - MARGIN / 2:  # below the threshold of the index
            return starts
        get = self.number.get
        numbers = np.array([get(w, 0) for w in words], dtype=np.int64)
        at = np.nonzero(numbers)[0]
        if not len(at):
            return starts[:0]
        step = starts[1] - starts[0] if len(starts) > 1 else length
        # a word lies in the passage that starts in its stride and, if that is shorter, in the one before
        last, held = len(starts) - 1, []
        for back in range(-(-length // step)):
            passage = np.minimum(at // step, last + 1) - back
            inside = (passage >= 0) & (passage <= last) & (at < passage * step + length)
            held.append(passage[inside] * len(self.start) + numbers[at[inside]])
        passage, terms = np.divmod(np.unique(np.concatenate(held)), len(self.start))
        sizes = self.start[terms + 1] - self.start[terms]
        flat = np.repeat(self.start[terms] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        unique, where = np.unique(np.repeat(passage, sizes) * self.n_blocks + self.block[flat], return_inverse=True)
        total = np.bincount(where, weights=self.bound[flat])
        found = total + self.rest[unique % self.n_blocks] >= threshold - 1e-9
        return starts[np.unique(unique[found] // self.n_blocks)]

    def search(self, terms: set[str], threshold: float) -> list[tuple[int, float]]:
        """All items that score the threshold or more against the terms: WAND with block maxima."""
        lists = [[0, self.postings[t], self.most[t], self.blocks[t]] for t in sorted(terms) if t in self.postings]
        out, lists = [], [x for x in lists if x[1]]
        need = threshold - 1e-9
        while lists:
            lists.sort(key=lambda x: x[1][x[0]][0])
            total, pivot = 0.0, -1
            for k, x in enumerate(lists):
                total += x[2]
                if total >= need:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[pivot][1][lists[pivot][0]][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][1][lists[pivot + 1][0]][0] == item:
                pivot += 1
            block = item // BLOCK
            if sum(x[3].get(block, 0.0) for x in lists[:pivot + 1]) < need:
                # nothing up to the block's end, or the next list's item, can reach the threshold
                goal = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    goal = min(goal, lists[pivot + 1][1][lists[pivot + 1][0]][0])
                goal = max(goal, item + 1)
            elif lists[0][1][lists[0][0]][0] == item:
                score = sum(x[1][x[0]][1] for x in lists[:pivot + 1])
                if score >= need:
                    out.append((item, score))
                goal = item + 1
            else:
                goal = item
            for x in lists[:pivot + 1]:
                if x[1][x[0]][0] < goal:
                    x[0] = bisect_left(x[1], (goal, -1.0), x[0])
            lists = [x for x in lists if x[0] < len(x[1])]
        return out

    def leaks(self, text: str | None, threshold: float, overlap: float) -> list[dict]:
        """Leaked items of a text, each with its best passage."""
        words = words_of(text)
        if not words:
            return []
        step, length = self.longest, 2 * self.longest
        starts = np.arange(0, max(1, len(words) - step), step)
        best: dict[int, dict] = {}
        for start in self.promising(words, starts, length, threshold).tolist():
            for place, score in self.search(set(words[start:start + length]), threshold):
                question, answer = self.parts[place]
                around = words[max(0, start - step):start + length + step]
                q, a = share(question, around), share(answer, around)
                if q >= overlap and a >= overlap and (place not in best or score > best[place]["score"]):
                    best[place] = {"entry": self.items[place].entry, "item_id": self.items[place].item_id, "score": round(score, 6),
                                   "question_overlap": q, "answer_overlap": a, "at": start}
        return [best[p] for p in sorted(best)]


def distinct_items(items: DataFrame) -> DataFrame:
    return items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()


def entry_of(text: str):
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def shards(items: DataFrame, size: int = SHARD, threshold: float = THRESHOLD):
    """Indexes over all items, each of about ``size`` texts; term frequencies are those of all items. A text
    under several ids is one entry with the smallest of them."""

    @F.arrow_udf("array<string>")
    def terms(texts: pa.Array) -> pa.Array:
        return pa.array((words_of(t.as_py()) for t in texts), pa.list_(pa.string()))

    texts = distinct_items(items).groupBy("text").agg(F.count("*").alias("copies"), F.min("item_id").alias("item_id"))
    rows = stored(texts.withColumn("terms", terms("text")).where(F.size("terms") > 0), "items")
    stats = rows.agg(F.sum("copies").alias("n"), (F.sum(F.col("copies") * F.size("terms")) / F.sum("copies")).alias("mean"),
                     F.count("*").alias("texts")).first()
    frequencies = rows.select(F.explode(F.array_distinct("terms")).alias("term"), "copies").groupBy("term").agg(F.sum("copies").alias("items"))
    n = -(-stats["texts"] // size)
    for k in range(n):
        mine = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        own = (mine.select("item_id", "text", F.explode(F.array_distinct("terms")).alias("term")).join(frequencies, "term")
               .groupBy("item_id", "text").agg(F.map_from_entries(F.collect_list(F.struct("term", "items"))).alias("f"))
               .withColumn("entry", entry_of("text")))
        # bounded by the size of a shard
        found = [Item(r["item_id"], r["text"], r["f"], bytes(r["entry"])) for r in own.orderBy("item_id", "text").collect()]
        yield Index(found, stats["n"], stats["mean"], threshold)


def finder(sent: Broadcast, threshold: float, overlap: float):
    kind = pa.list_(pa.struct([("entry", pa.binary()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()),
                               ("answer_overlap", pa.float64()), ("at", pa.int32())]))

    @F.arrow_udf(LEAKS)
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([sent.value.leaks(t.as_py(), threshold, overlap) for t in texts], kind)

    return find


def with_leaks(docs: DataFrame, items: DataFrame, text: str = "text", name: str = "leaks", threshold: float = THRESHOLD,
               overlap: float = OVERLAP, shard: int = SHARD) -> DataFrame:
    """``docs`` with an array of the items that a text holds, of items with one text the one with the smallest
    id. Texts stay where they are."""
    docs = docs.withColumn(name, F.array().cast(LEAKS))
    for index in shards(items, shard, threshold):
        find = finder(docs.sparkSession.sparkContext.broadcast(index), threshold, overlap)
        docs = docs.withColumn(name, F.concat(F.col(name), find(F.col(text))))
    return docs


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """A row per text and leaked item."""
    found = with_leaks(docs, items, **how).select(key, F.explode("leaks").alias("leak")).select(key, "leak.*").drop("item_id")
    ids = distinct_items(items).where(F.col("text").isNotNull()).select(entry_of("text").alias("entry"), "item_id")
    return (fan_out_join(stored(found, "leaks"), stored(ids, "ids"), ["entry"], [key, "at"])
            .select(key, "item_id", "score", "question_overlap", "answer_overlap", "at"))
