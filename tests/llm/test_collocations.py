"""Phrase collocations against a plain version."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from covista.llm import collocations, filters

FOLDER = "/root/testdata/sf0.001"


def plain(rows, least, best, share=80):
    """[(lang, rank, phrase, a, l, r, n, score)] with exact integers."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 5):
                counts.update((lang, *words[i:i + size]) for i in range(len(words) - size + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    out = []
    for (lang, *words), a in candidates.items():
        held = any(100 * b >= share * a for (other, *longer), b in candidates.items() if other == lang and len(longer) > len(words)
                   and any(longer[i:i + len(words)] == words for i in range(len(longer) - len(words) + 1)))
        if not held:
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
                cuts.append((2000000 * a // (left + right), k, left, right))
            s, _, left, right = min(cuts)
            out.append((lang, -s, -a, " ".join(words).encode(), left, right))
    rows = []
    for lang in sorted(total):
        mine = sorted(x for x in out if x[0] == lang)[:best]
        rows += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (_, s, a, p, left, right) in enumerate(mine)]
    return rows


def found(df, **options):
    return [tuple(r) for r in collocations.collocations(df, **options).orderBy("lang", "rank").collect()]


def speech(rng, n, kinds=6):
    marks = [" "] * 9 + [", ", ".\n", "\t", " ; "]
    return "".join(rng.choice("AbCdefÄ")[:1] * rng.randint(1, kinds // 3) + rng.choice(marks) for _ in range(n))


@pytest.mark.parametrize("seed, least, best", [(1, 2, 2000), (2, 5, 2000), (3, 3, 7)])
def test_phrases_of_small_alphabets(spark, seed, least, best):
    rng = random.Random(seed)
    rows = [(rng.choice(["en", "de", None, "und"]), speech(rng, rng.randint(0, 200))) for _ in range(40)]
    rows += [("en", None), (None, ""), ("fr", " \t\n"), ("fr", "one"), ("de", "a\x00 a\x01 a a\x00 a\x01 a a\x00 a\x01 a. a\x1f a  a")]
    rows += [rows[0]] * 3
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("lang", "text", "1 AS n", "2 AS phrase", "3 AS words", "4 AS size")
    assert found(df, least=least, best=best, chunk=300) == plain(rows, least, best)


def test_a_saturated_filter_changes_nothing(spark):
    rng = random.Random(9)
    rows = [("en", " ".join(f"w{rng.randrange(40)}" for _ in range(2000)))]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(df, least=3, bits=15) == found(df, least=3) == plain(rows, 3, 2000)


def test_filter_passes_all_members(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("h"))
    bits = filters.built(df, "h", 18)
    import numpy as np
    members = np.array([r["h"] for r in df.collect()], dtype=np.int64).view(np.uint64)
    strangers = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64)
    assert filters.passes(bits, members).all() and filters.passes(bits, strangers).mean() < 0.05
    assert not filters.passes(filters.built(df.limit(0), "h", 18), members).any()


def test_paths_open_across_tasks(spark):
    """One beginning with so many phrases that its stream is cut between them."""
    rows = [("en", ". ".join(f"of the w{i} x" for i in range(500) for _ in range(2)))]
    df = spark.createDataFrame(rows, "lang string, text string")
    stream = collocations.in_order(collocations.summed(collocations.short_counts(df).unionByName(
        collocations.long_counts(df, collocations.pair_filter(collocations.summed(collocations.short_counts(df), 2).where("size = 2")))), 2), False)
    assert stream.rdd.getNumPartitions() > 1
    assert found(df, least=2) == plain(rows, 2, 2000)


def test_empty_table_and_very_long_text(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert found(df) == []
    rows = [("en", "red hot chili. " * 200_000 + "word " * 100_000)]
    assert found(spark.createDataFrame(rows, "lang string, text string")) == plain(rows, 30, 2000)


def test_score_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    row = spark.createDataFrame([(big, big, big - 7)], "a bigint, l bigint, r bigint").select(
        collocations.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()
    assert row["s"] == 2_000_000 * big // (2 * big - 7)
