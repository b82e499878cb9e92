"""Quality rules with thresholds that follow the data, from mergeable quantile sketches.

A sketch of a measure is a table of counts per bucket: non-negative integers are cut to their 6 highest
bits, so a bucket is at most 1/32 of its value wide. Counts add up, so sketches of partitions, sources
and languages merge exactly and in any order. Thresholds of a (language, source) come from its own
sketch when it has enough documents, else from that of its language, else from that of all documents.
DataFrame functions only; nothing grows with the data but the documents themselves.

Null language or source are groups of their own. A null or empty text has no words and fails.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Separators of words, characters that count as symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]"
WINDOW = 5


@dataclass(frozen=True)
class Fence:
    """A measure and how far beyond its quartiles a document may lie, as a multiple of their distance;
    ``slack`` is added to a fence for measures whose quartiles may coincide."""

    measure: str
    reach: float = 6.0
    slack: int = 0
    low: bool = False


# Parts per thousand, but for word_size (hundredths of a character).
FENCES = (
    Fence("symbol_rate", slack=100),
    Fence("word_size", slack=150, low=True),
    Fence("dup_line_rate", slack=300),
    Fence("repeat_rate", slack=200),
    Fence("shout_rate", slack=200),
)
# a group with fewer documents borrows the sketch above it
LEAST_DOCUMENTS = 100


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, even inside lambdas."""
    return F.transform(F.array(value), use)[0]


def repeat_words(words: Column) -> Column:
    """Words in windows of five words that occur twice or more, first ones included.

    Windows are compared by a 64-bit hash of the hashes of their words. Where a text repeats itself,
    its windows are sorted with their places; the gaps between repeated places give the cover.
    """
    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def cover(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        at = bound(placed, lambda p: F.filter(p, lambda v, k: (F.get(p, k - 1)["x"] == v["x"]) | F.coalesce(
            F.get(p, k + 1)["x"] == v["x"], F.lit(False))))
        places = F.sort_array(F.transform(at, lambda v: v["i"]))
        return bound(places, lambda p: F.aggregate(
            F.transform(p, lambda v, k: F.least(F.coalesce(F.get(p, k + 1) - v, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0), lambda a, v: a + v))

    def counted(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(cover(w))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    made = bound(hashed, lambda h: bound(windows(h), counted))
    return F.when(F.size(words) >= WINDOW, made).otherwise(0).cast("long")


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_shouts."""
    value = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(value, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(WORD))
    bare = F.translate(value, SPACES, "")
    row = F.struct(
        bound(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words"))).alias("of_words"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length(value) - F.length(F.translate(value, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bound(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("of_lines"),
        (F.length(value) - F.length(F.translate(value, "!?", ""))).cast("long").alias("n_shouts"))
    made = ("n_words", "n_repeat_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_shouts")
    return (df.drop(*made).withColumn("_row", row)
            .select(*[c for c in df.columns if c not in made], "_row.of_words.*", "_row.word_chars", "_row.n_symbols", "_row.of_lines.*", "_row.n_shouts"))


def rates() -> dict[str, Column]:
    """Measures of a counted document, as integers."""
    words, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "n_lines"))
    parts = {
        "symbol_rate": F.col("n_symbols") * 1000 / words,
        "word_size": F.col("word_chars") * 100 / words,
        "dup_line_rate": F.col("n_dup_lines") * 1000 / lines,
        "repeat_rate": F.col("n_repeat_words") * 1000 / words,
        "shout_rate": F.col("n_shouts") * 1000 / words,
    }
    return {k: F.floor(v).cast("long") for k, v in parts.items()}


def bucket(value: Column) -> Column:
    """The value with all but its 6 highest bits zero."""
    cut = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    unit = F.pow(F.lit(2.0), cut.cast("double")).cast("long")
    return value - F.pmod(value, unit)


def sketch(df: DataFrame, values: dict[str, Column], keys: list[str]) -> DataFrame:
    """Rows (keys, measure, bucket, n): the quantile sketch of each measure per key."""
    each = F.array(*[F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket")) for k, v in values.items()])
    return (df.select(*keys, F.explode(each).alias("_m")).groupBy(*keys, "_m.measure", "_m.bucket")
            .agg(F.count("*").alias("n")))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser keys, by adding counts."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and measure: the buckets in which the first and third quarter of the rows end.

    A measure has a few hundred buckets at most, so a key's rows fit in any task.
    """
    by = Window.partitionBy(*keys, "measure")
    placed = sketches.withColumn("_upto", F.sum("n").over(by.orderBy("bucket"))).withColumn("_all", F.sum("n").over(by))
    return placed.groupBy(*keys, "measure").agg(
        F.max("_all").alias("n_documents"),
        F.min(F.when(F.col("_upto") * 4 >= F.col("_all"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("_upto") * 4 >= F.col("_all") * 3, F.col("bucket"))).alias("q3"))


def thresholds(sketches: DataFrame, fences: tuple[Fence, ...] = FENCES, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """A row per (lang, source) with a lowest and highest value for each measure."""
    own = quartiles(sketches, ["lang", "source"])
    of_lang = quartiles(merged(sketches, ["lang"]), ["lang"]).select(
        F.col("lang").alias("_lang"), F.col("measure").alias("_m"), *[F.col(c).alias(f"l_{c}") for c in ("n_documents", "q1", "q3")])
    of_all = quartiles(merged(sketches, []), []).select(
        F.col("measure").alias("_a"), *[F.col(c).alias(f"a_{c}") for c in ("q1", "q3")])
    rows = (own.join(of_lang, own["lang"].eqNullSafe(of_lang["_lang"]) & (own["measure"] == of_lang["_m"]))
            .join(of_all, own["measure"] == of_all["_a"]))

    def pick(c: str) -> Column:
        return (F.when(F.col("n_documents") >= least, F.col(c)).when(F.col("l_n_documents") >= least, F.col(f"l_{c}"))
                .otherwise(F.col(f"a_{c}")))

    low, high, spread = pick("q1"), pick("q3"), pick("q3") - pick("q1")
    cells = []
    for f in fences:
        mine = F.col("measure") == f.measure
        cells.append(F.max(F.when(mine, high + f.reach * spread + f.slack)).alias(f"{f.measure}_high"))
        if f.low:
            cells.append(F.max(F.when(mine, low - f.reach * spread - f.slack)).alias(f"{f.measure}_low"))
    return rows.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(*cells)


def judged(counted: DataFrame, fences: tuple[Fence, ...] = FENCES, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Counted documents with base_failed and kept. ``counted`` is read twice: store it first."""
    values = rates()
    limits = thresholds(sketch(counted, values, ["lang", "source"]), fences, least)
    inside = F.lit(True)
    for f in fences:
        inside = inside & (values[f.measure] <= F.col(f"{f.measure}_high"))
        if f.low:
            inside = inside & (values[f.measure] >= F.col(f"{f.measure}_low"))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return (counted.join(limits, counted["lang"].eqNullSafe(limits["_lang"]) & counted["source"].eqNullSafe(limits["_source"]), "left")
            .withColumn("base_failed", failed).withColumn("kept", ~failed & inside)
            .drop("_lang", "_source"))
