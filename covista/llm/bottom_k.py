"""Near duplicates by word shingles, found through bottom-k sketches of one hash function.

A document's set are the 64-bit hashes of its distinct shingles; its sketch are the k smallest of them. Documents
with equal sets are one. Two sets whose Jaccard similarity reaches the threshold share, among the k smallest values of
their union, at least ``least_shared`` values, but for a chance below ``MISS`` a pair; all these stand in both sketches. So

* a set can only have partners if that many of its values occur in other sketches at all;
* with values in order of their frequency, rarest first, partners share a value among the first
  ``size - needed + 1`` of each: only these values get inverted lists, and very common ones hardly ever do;
* for two sets that meet in a list, the k smallest values of the union are told from the shared ones and their ranks,
  and the pair goes on if enough of them are shared. Sets of at most k shingles are compared exactly at once.

First every set names one other of its lists: of each list the set whose values are the most common stands at
its head (an original stands so before its changed copies), and the set takes the head that it meets in most lists. These
pairs, one a set, are verified on the full sets and make components. What is left are lists
that still hold several components, cut in cells, blocks met by blocks: their pairs are estimated, the sets of those that go on are brought to the cell and
verified there, and a cell hands on a forest of links. So no list of all pairs is ever written, and large groups of near
copies cost little. Full sets are made a second time, for sets with lists only, and not stored for all documents.

Nulls and texts without words have the empty set, which is linked with nothing. Shorter texts than a shingle are one
shingle. Repeated rows and ties link like any other rows; null keys don't count as the smallest of a component, and a
component without another key has none. An empty table gives an empty one. A text is held whole by its task; columns
but key and text are not read. Sets are compared by hashes: about one in 10^13 pairs of sets could gain a shared shingle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.llm import filters
from covista.plans import Workspace, components, fan_out_join, spread
from covista.plans.components import forest

K = 64
MISS = 1e-9
# sets of an inverted list that meet in one piece
BLOCK = 1024
# values of a cell that are compared at a time
COLUMNS = 4096
# of an entry with its rank in the last byte
VALUE = np.uint64(~0xFF & (1 << 64) - 1)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 26
# texts a task remembers as already sent
REMEMBERED = 100_000
# texts whose words a task holds at a time
PIECE_ROWS = 128


def least_shared(k: int, percent: int, miss: float = MISS) -> int:
    """The most values c such that fewer than c of k shared ones are less likely than ``miss`` (Chernoff's bound,
    which holds for draws without replacement) at a similarity of ``percent``."""
    j = percent / 100
    if j >= 1:
        return k
    c = 0
    while c < k * j:
        x = c / k
        apart = (x * math.log(x / j) if x else 0.0) + (1 - x) * math.log((1 - x) / (1 - j))
        if math.exp(-k * apart) > miss:
            break
        c += 1
    return max(1, c)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Hashes of the distinct shingles, ascending."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(size, len(words))
    out = np.zeros(len(h) - size + 1, dtype=np.uint64)
    for k in range(size):
        out = (out ^ h[k:k + len(out)]) * FACTOR
    out ^= out >> np.uint64(32)
    return np.unique(out * FACTOR)


def text_hash(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (t.as_py() or b"" for t in column.cast(pa.binary()))


def pieces(columns: Iterator[pa.Array], rows: int = PIECE_ROWS) -> Iterator[pa.Array]:
    """Columns of texts cut small: the words of a piece are held as single objects, many times the size of its texts."""
    for column in columns:
        for at in range(0, len(column), rows):
            yield column.slice(at, rows)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def sketched(docs: DataFrame, size: int, k: int) -> DataFrame:
    """(key, n, digest, words, sketch): number and digest of a row's shingles, digest of its words, sketch."""

    def run(batches):
        for batch in batches:
            counts, digests, of_words, sketches = [], [], [], []
            for text in _texts(batch.column("text")):
                words = words_of(text)
                found = shingles(words, size)
                counts.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                of_words.append(text_hash(words))
                sketches.append(found[:k])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                                              pa.array(of_words, pa.binary()), _lists(sketches)], ["key", "n", "digest", "words", "sketch"])

    return docs.select("key", "text").mapInArrow(
        run, f"key {docs.schema['key'].dataType.simpleString()}, n bigint, digest binary, words binary, sketch array<bigint>")


def listed(sets: DataFrame, percent: int, k: int) -> DataFrame:
    """(id, n, weight, held, firsts): sets that may have partners. ``held`` are the set's values that occur elsewhere,
    rarest first, each with its rank in the sketch in its last byte; ``firsts`` those that have lists; ``weight`` adds up how
    often its values occur."""
    needed = F.least(F.lit(least_shared(k, percent)), F.ceil(F.col("n") * percent / 100)).cast("int")
    values = sets.select("id", F.posexplode("sketch").alias("rank", "value"))
    common = values.groupBy("value").agg(F.count("*").alias("sets")).where("sets > 1")
    ranked = values.join(common, "value").groupBy("id").agg(F.sum("sets").alias("weight"), F.array_sort(F.collect_list(F.struct(
        "sets", "value", (F.col("value").bitwiseAND(F.lit(~0xFF)) + F.col("rank") + 1).alias("held")))).alias("values"))
    return (ranked.join(sets.select("id", "n", needed.alias("needed")), "id")
            .withColumn("prefix", F.size("values") - F.col("needed") + 1).where("prefix > 0")
            .select("id", "n", "weight", F.transform("values", lambda v: v["held"]).alias("held"),
                    F.transform(F.slice("values", 1, F.col("prefix")), lambda v: v["value"]).alias("firsts")))


def heads(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each set of the lists (value, id, n, weight) the head that it meets in most of them."""
    first = lists.groupBy("value").agg(F.max(F.struct("weight", "id", "n")).alias("head"))
    alike = (F.col("n") * 100 >= F.col("head.n") * percent) & (F.col("head.n") * 100 >= F.col("n") * percent)
    met = lists.join(first, "value").where((F.col("id") != F.col("head.id")) & alike).groupBy("id", "head").agg(F.count("*").alias("lists"))
    return met.groupBy("id").agg(F.max(F.struct("lists", "head")).alias("best")).select(F.col("id").alias("a"), F.col("best.head.id").alias("b"))


def cut(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """(value, cell, block, id, root): the lists of several components, in cells of two blocks."""
    lists = lists.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    cuts = (lists.groupBy("value").agg(F.count("*").alias("sets"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
            .select("value", F.ceil(F.col("sets") / BLOCK).cast("int").alias("cuts")))
    block = F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")
    # a block meets itself and every other block once
    met = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda other: F.least(F.col("block"), other) * F.col("cuts") + F.greatest(F.col("block"), other))
    return lists.select("value", "id", "root").join(cuts, "value").withColumn("block", block).select("value", F.explode(met).alias("cell"), "block", "id", "root")


def by_cell(rows: DataFrame) -> DataFrame:
    return rows.repartition(spread(rows), "value", "cell").sortWithinPartitions("value", "cell")


def cells(batches) -> Iterator[pa.Table]:
    """The rows of each cell of a sorted stream."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        value, cell = batch.column("value").to_numpy(), batch.column("cell").to_numpy()
        cuts = np.nonzero((value[1:] != value[:-1]) | (cell[1:] != cell[:-1]))[0] + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            key = (value[a], cell[a])
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            last = key
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
    if held:
        yield pa.concat_tables(held)


def repeated(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(values, list, place in it, column) of the entries whose value stands in several lists; one column a value."""
    kinds, which, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    sizes = [len(x) for x in lists]
    rows, places = np.repeat(np.arange(len(lists)), sizes), np.concatenate([np.arange(n) for n in sizes])
    several = counts > 1
    kept = several[which]
    return kinds[several], rows[kept], places[kept], (np.cumsum(several) - 1)[which[kept]]


def shared(lists: list[np.ndarray]) -> np.ndarray:
    """How many values each two lists share."""
    kinds, rows, _, columns = repeated(lists)
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    out = np.zeros((len(lists), len(lists)), dtype=np.float32)
    for at in range(0, len(kinds), COLUMNS):
        a, b = np.searchsorted(columns, [at, at + COLUMNS])
        part = np.zeros((len(lists), min(COLUMNS, len(kinds) - at)), dtype=np.float32)
        part[rows[a:b], columns[a:b] - at] = 1
        out += part @ part.T
    return out


class Cell:
    """The sets of a cell, in order of their ids, and which pairs of different components may be linked."""

    def __init__(self, table: pa.Table, percent: int, k: int):
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.order, self.ids, self.percent, self.k, self.least = order, ids[order], percent, k, least_shared(k, percent)
        self.n, self.block, self.root, self.prefix = (table.column(c).to_numpy()[order] for c in ("n", "block", "root", "prefix"))
        column = table.column("held").combine_chunks()
        starts, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
        self.held = [flat[starts[i]:starts[i + 1]] for i in order]
        self.value = (table.column("value").to_numpy()[:1].view(np.uint64) & VALUE)[0]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs that may be linked."""
        alike = self.n[:, None] * 100 >= self.percent * self.n[None, :]
        open_ = alike & alike.T & (self.root[:, None] != self.root[None, :])
        if (self.block != self.block[0]).any():
            open_ &= self.block[:, None] != self.block[None, :]
        open_ = np.triu(open_, 1)
        if not open_.any():
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        values = [x & VALUE for x in self.held]
        needed = np.minimum(self.least, -(-self.n * self.percent // 100))
        open_ &= shared(values) >= np.maximum(needed[:, None], needed[None, :])
        # ranks of values by set, in order of the values, and which of them have lists
        kinds, rows, places, columns = repeated(values)
        ranks = np.zeros((len(values), len(kinds)), dtype=np.uint8)
        listed = np.zeros((len(values), len(kinds)), dtype=bool)
        ranks[rows, columns] = (np.concatenate(self.held) & ~VALUE).astype(np.uint8)[np.cumsum([0, *map(len, values)])[rows] + places]
        listed[rows, columns] = places < self.prefix[rows]
        own = int(np.searchsorted(kinds, self.value))
        out = [(i, j) for i in np.nonzero(open_.any(1))[0].tolist() if len(j := self.similar(i, np.nonzero(open_[i])[0], ranks, listed, own))]
        return (np.concatenate([np.full(len(j), i) for i, j in out] or [np.empty(0, dtype=np.int64)]),
                np.concatenate([j for _, j in out] or [np.empty(0, dtype=np.int64)]))

    def similar(self, i: int, others: np.ndarray, ranks: np.ndarray, listed: np.ndarray, own: int) -> np.ndarray:
        """The sets with which ``i`` shares enough of the smallest values of the union. A pair is looked at in the list of
        the smallest value that both have a list for, and in no other."""
        mine = np.nonzero(listed[i])[0]
        others = others[mine[listed[np.ix_(others, mine)].argmax(1)] == own]
        mine = np.nonzero(ranks[i])[0]
        theirs = ranks[np.ix_(others, mine)]
        both = theirs > 0
        order = np.cumsum(both, axis=1)
        total = order[:, -1]
        # a shared value's place in the union counts the values before it in either, the shared ones once
        kept = (both & (ranks[i, mine].astype(np.int16)[None, :] + theirs - order <= self.k)).sum(1)
        whole = (self.n[i] <= self.k) & (self.n[others] <= self.k)
        return others[np.where(whole, total * 100 >= self.percent * (self.n[i] + self.n[others] - total), kept >= self.least)]


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(id, hashes) for the wanted sets (id, words), made again from the texts."""
    hashed = wanted.select(F.xxhash64("words").alias("h"))
    sent = docs.sparkSession.sparkContext.broadcast(filters.built(hashed, "h", FILTER_BITS))

    def run(batches):
        seen: set[bytes] = set()
        for column in pieces(batch.column("text") for batch in batches):
            keys, found = [], []
            split = [words_of(t) for t in _texts(column)]
            digests = [text_hash(w) for w in split]
            for digest, words, passed in zip(digests, split, filters.passes(sent.value, spark_hashes(digests))):
                if passed and digest not in seen:
                    seen.add(digest)
                    keys.append(digest)
                    found.append(shingles(words, size))
            if len(seen) > REMEMBERED:
                seen = set()
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), _lists(found)], ["words", "hashes"])

    made = docs.select("text").mapInArrow(run, "words binary, hashes array<bigint>")
    return made.join(wanted, "words").groupBy("id").agg(F.first("hashes").alias("hashes"))


def spark_hashes(digests: list[bytes]) -> np.ndarray:
    """Spark's xxhash64 (seed 42) of each digest."""
    return np.fromiter((xxhash.xxh64_intdigest(d, 42) for d in digests), dtype=np.uint64, count=len(digests))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets (ascending, distinct) reach the similarity: 100 |A and B| >= percent |A or B|."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    at = np.searchsorted(large, small)
    shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the full sets confirm. Many pairs may name the same b."""

    @F.arrow_udf("boolean")
    def confirmed(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([linked(p.values.to_numpy().view(np.uint64), q.values.to_numpy().view(np.uint64), percent) for p, q in zip(x, y)])

    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("right"))
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("left"))
    both = fan_out_join(pairs, right, ["b"], ["a"], 4096).join(left, "a")
    return both.where(confirmed("left", "right")).select("a", "b")


def asked(rows: DataFrame, percent: int, k: int) -> DataFrame:
    """The rows of cells whose sets have a possible link to another component there."""

    def run(batches):
        for table in cells(batches):
            cell = Cell(table, percent, k)
            found = np.unique(np.concatenate(cell.pairs()))
            if len(found):
                yield from table.take(pa.array(cell.order[found])).to_batches()

    return by_cell(rows).mapInArrow(run, rows.schema)


def linked_in_cells(rows: DataFrame, sets: DataFrame, percent: int, k: int) -> DataFrame:
    """(a, b): links that connect the components of each cell as its full sets do."""

    def run(batches):
        for table in cells(batches):
            cell = Cell(table, percent, k)
            a, b = cell.pairs()
            if not len(a):
                continue
            column = table.column("hashes")
            both = shared([column[int(i)].values.to_numpy() for i in cell.order])[a, b].astype(np.int64)
            good = 100 * both >= percent * (cell.n[a] + cell.n[b] - both)
            x, y = forest(cell.ids[a[good]], cell.ids[b[good]])
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return by_cell(rows.join(sets, "id")).mapInArrow(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 85, k: int = K) -> DataFrame:
    """(key, n_shingles, component_id, kept) per row of ``df``: rows are linked when 100 times their shared shingles are
    at least ``percent`` times all they have; ``component_id`` is the smallest key reachable, own row included."""
    if not 0 < k < 256:
        raise ValueError("a rank in a sketch is kept in one byte")
    work = Workspace(df.sparkSession)
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = work.store(sketched(docs, words, k), "sketches")
    sets = work.store(rows.where("n > 0").groupBy("digest").agg(F.min("words").alias("words"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
                                                                F.min("key").alias("first")).withColumn("id", F.monotonically_increasing_id()), "sets")
    held = work.store(listed(sets, percent, k), "sets-with-lists")
    lists = held.select("id", "n", "weight", F.explode("firsts").alias("value"))
    named = work.store(heads(lists, percent), "heads")
    several = lists.groupBy("value").agg(F.count("*").alias("sets")).where("sets > 1")
    wanted = lists.join(several, "value").select("id").distinct().join(sets.select("id", "words"), "id")
    full = work.store(full_sets(docs, wanted, words), "full-sets")
    links = work.store(verified(named, full, percent), "links")
    roots = work.store(components(links, work), "roots")
    left = cut(lists, roots).join(held.select("id", "n", F.size("firsts").alias("prefix"), "held"), "id")
    more = work.store(linked_in_cells(work.store(asked(left, percent, k), "open-cells"), full, percent, k), "links")
    if not more.isEmpty():
        roots = work.store(components(links.unionByName(more), work), "roots")
    placed = sets.select("digest", "id", "first").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    lowest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    of_set = placed.join(lowest, "root").select("digest", "component_id")
    found = rows.select("key", "n", "digest").join(of_set.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"))
