"""Operators that look at the corpus as a whole, and the pipeline."""

import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from covista.llm import decontaminate, quality_classifier, simhash, substrings, warc
from covista.llm.queries import QUERIES
from covista.plans import Workspace, components
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def prose(rng, n, kinds=60):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


@pytest.mark.parametrize("size", [1, 2, 5, 12])
def test_repeats_on_small_alphabets(spark, size):
    rng = random.Random(size)
    texts = [prose(rng, rng.randint(0, 40), 4) for _ in range(40)] + [None, "", " ", "a " * 50, "a " * 50, "b " * 3]
    shared = prose(rng, size + 3)
    texts += [f"{prose(rng, 9)} {shared} {prose(rng, 5)}" for _ in range(3)]
    df = frame(spark, texts).selectExpr("doc_id", "text", "1 AS n_words", "2 AS row")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.without_repeats(df, size=size).collect()}
    assert got == dict(enumerate(brute.without_repeats(texts, size)))


def test_repeats_with_equal_and_null_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "x y z"), (None, "q x y z"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substrings.without_repeats(df, size=3).collect())
    assert got == [(0, 3, 3), (0, 4, 3), (1, 4, 4), (1, 4, 4), (2, 0, 0)]
    assert substrings.without_repeats(df.limit(0), size=3).count() == 0


def test_repeats_query(spark):
    docs = documents(spark)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in QUERIES["op4_substrings"](spark, FOLDER).collect()}
    assert got == dict(zip([d["doc_id"] for d in docs], brute.without_repeats([d["text"] for d in docs], 35)))


def test_levels_double():
    assert substrings.levels(35) == [9, 18, 35] and substrings.levels(1) == [1] and substrings.levels(8) == [2, 4, 8]


def test_golay_keys_meet_within_three_bits():
    index, words = simhash.codewords_near()
    assert (index >= 0).all() and min(int(np.bitwise_count(w)) for w in words[1:]) == 7
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    one, two = simhash.keys_of(a), simhash.keys_of(b)
    entries = set(zip(one.loc[~one.probe, "key"], one.loc[~one.probe, "print"]))
    probes = two[two.probe].groupby("print")["key"].apply(set)
    for x, y in zip(a.view(np.int64), b.view(np.int64)):
        assert any((k, x) in entries for k in probes[y])


def test_links_of_dense_groups(spark, monkeypatch):
    """Many prints a few bits apart, with keys cut in small blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = random.Random(5)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "print bigint")
    found = simhash.links(df).collect()
    near = {}
    for i, x in enumerate(brute.components(prints, list(range(len(prints))))):
        near[int(np.uint64(prints[i]).view(np.int64))] = x
    label = {p: p for p in near}
    for _ in range(len(prints)):
        moved = False
        for r in found:
            low = min(label[r["a"]], label[r["b"]])
            moved |= label[r["a"]] != low or label[r["b"]] != low
            label[r["a"]] = label[r["b"]] = low
        if not moved:
            break
    assert all((near[p] == near[q]) == (label[p] == label[q]) for p in near for q in near)


def test_keys_of_few_prints_are_not_broadcast(spark):
    """Some sixty keys a print, which Spark takes for one row: a few MB of prints would send hundreds through the driver."""
    found = simhash.links(spark.range(3000).select(F.xxhash64("id").alias("print")))
    found.collect()
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text


def test_components_of_paths(spark):
    work = Workspace(spark)
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), work).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_near_duplicates_of_odd_rows(spark):
    texts = [None, "", "One two THREE four five", "one two three FOUR five", "Ä b", "x " * 3000, "x " * 3000, "a", "a b"]
    ids = [5, None, 9, 3, 4, None, None, 1, 2]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").selectExpr("doc_id", "text", "1 AS key", "2 AS print")
    prints = [brute.fingerprint(t) for t in texts]
    want = sorted(zip([i or 0 for i in ids], [f"{p:016x}" for p in prints], [c or 0 for c in brute.components(prints, ids)]))
    got = simhash.near_duplicates(df).collect()
    assert sorted((r["doc_id"] or 0, r["fingerprint"], r["component_id"] or 0) for r in got) == want
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_query(spark):
    docs = documents(spark)
    prints, ids = [brute.fingerprint(d["text"]) for d in docs], [d["doc_id"] for d in docs]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op7_simhash"](spark, FOLDER).collect()}
    assert got == {i: (f"{p:016x}", c) for i, p, c in zip(ids, prints, brute.components(prints, ids))}


def some_items(rng, n):
    return [decontaminate.Item(i, t := f"{prose(rng, 20, 300)}. {prose(rng, 6, 300)}.", {}) for i in range(n)]


def test_wand_finds_all_above_the_threshold():
    rng = random.Random(2)
    items = some_items(rng, 100)
    df = {}
    for x in items:
        for w in set(decontaminate.words_of(x.text)):
            df[w] = df.get(w, 0) + 1
    for x in items:
        x.frequencies = {w: df[w] for w in decontaminate.words_of(x.text)}
    index = decontaminate.Index(items, len(items), 26.0)
    for _ in range(60):
        terms = set(rng.sample([f"w{i}" for i in range(300)], 80)) | set(decontaminate.words_of(rng.choice(items).text)[:rng.randint(0, 26)])
        for threshold in (0.2, 0.35, 0.6, 0.9):
            score = {}
            for t in terms:
                for place, x in index.postings.get(t, []):
                    score[place] = score.get(place, 0) + x
            want = {p for p, s in score.items() if s >= threshold}
            assert {p for p, _ in index.search(terms, threshold)} == want


def test_leaks_are_found_and_clean_texts_left(spark):
    rng = random.Random(4)
    items = [(i, f"{prose(rng, 18, 400)}. {prose(rng, 7, 400)}.") for i in range(30)]
    texts = [prose(rng, 500, 400) for _ in range(20)] + [None, "", "w1"]
    planted = [(k, i, f"{prose(rng, rng.randint(0, 200), 400)} {items[i][1].upper()} {prose(rng, rng.randint(0, 90), 400)}") for k, i in enumerate((3, 3, 29, 0), len(texts))]
    question_only = f"{prose(rng, 30, 400)} {items[7][1].split('.')[0]} {prose(rng, 30, 400)}"
    docs = frame(spark, [*texts, *[t for *_, t in planted], question_only]).selectExpr("doc_id", "text", "1 AS leak", "2 AS leaks", "3 AS item_id")
    bench = spark.createDataFrame([*items, (99, None), (98, "")], "item_id bigint, text string")
    for shard in (1000, 7):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench, shard=shard).collect()}
        assert got == {(k, i) for k, i, _ in planted}
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0 and decontaminate.leaks(docs.limit(0), bench).count() == 0


def with_frequencies(items):
    df = {}
    for x in items:
        for w in set(decontaminate.words_of(x.text)):
            df[w] = df.get(w, 0) + 1
    for x in items:
        x.frequencies = {w: df[w] for w in decontaminate.words_of(x.text)}
    return items


def test_every_block_of_common_terms_is_tried():
    """Copies under several ids, a third of all items, and items of one template: no rare terms in them."""
    rng = random.Random(6)
    items = some_items(rng, 40)
    copied = f"{prose(rng, 12, 400)}. {prose(rng, 5, 400)}."
    items += [decontaminate.Item(100 + i, copied, {}) for i in range(20)]
    items += [decontaminate.Item(200 + i, f"name the colour of stone {'abc'[i % 3]} in hall {'xyz'[i // 3 % 3]}. it is {'de'[i % 2]}.", {}) for i in range(18)]
    index = decontaminate.Index(with_frequencies(items), len(items), 20.0)
    texts = [prose(rng, 300, 400) for _ in range(10)]
    texts += [f"{prose(rng, rng.randint(0, 80), 400)} {x.text} {prose(rng, rng.randint(0, 80), 400)}" for x in items[::3]]
    texts += [f"{'other ' * rng.randint(0, 80)}{x.text}{' other' * rng.randint(0, 80)}" for x in items[::3]]
    for threshold in (0.3, 0.6, 0.9):
        for text in texts:
            words = decontaminate.words_of(text)
            starts = np.arange(0, max(1, len(words) - index.longest), index.longest)
            length = 2 * index.longest
            want = {s for s in starts.tolist() if index.search(set(words[s:s + length]), threshold)}
            assert want <= set(index.promising(words, starts, length, threshold).tolist())


def test_leaks_of_items_under_several_ids(spark):
    rng = random.Random(7)
    items = [(i, f"{prose(rng, 18, 400)}. {prose(rng, 7, 400)}.") for i in range(30)]
    items += [(100 + i, items[0][1]) for i in range(20)]
    docs = frame(spark, [prose(rng, 300, 400), f"{'other ' * 60}{items[0][1]}{' other' * 60}"])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {(1, 0), *((1, 100 + i) for i in range(20))}


def test_leaks_of_repeated_items(spark):
    """Rows twice, one text under several ids (one null), one id with several texts."""
    rng = random.Random(8)
    a, b, c = (f"{prose(rng, 18, 400)}. {prose(rng, 7, 400)}." for _ in range(3))
    items = [(1, a), (1, a), (2, a), (None, a), (3, b), (3, c), (3, c), (9, None), (9, None), (8, "")]
    docs = frame(spark, [f"{prose(rng, 30, 400)} {a}", f"{b} {c}", prose(rng, 50, 400), None, a])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for shard in (1000, 1):
        got = sorted((r["doc_id"], r["item_id"] or 0) for r in decontaminate.leaks(docs, bench, shard=shard).collect())
        assert got == [(0, 0), (0, 1), (0, 2), (1, 3), (1, 3), (4, 0), (4, 1), (4, 2)]
        held = decontaminate.with_leaks(docs, bench, shard=shard).orderBy("doc_id").collect()
        assert [len(r["leaks"]) for r in held] == [1, 2, 0, 0, 1]
    sizes = [len(x.items) for x in decontaminate.shards(spark.createDataFrame([(i, a) for i in range(50)], "item_id bigint, text string"), 10)]
    assert sizes == [1]


def test_leak_query(spark):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    want = set()
    for d in documents(spark):
        line = " ".join(decontaminate.words_of(d["text"]))
        want |= {(d["doc_id"], x["item_id"]) for x in items if " ".join(decontaminate.words_of(x["text"])) in line}
    assert {(r["doc_id"], r["item_id"]) for r in QUERIES["op6_decontamination"](spark, FOLDER).collect()} >= want


def test_quality_classifier(spark):
    known = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = QUERIES["op8_quality_classifier"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    right = [known[r["doc_id"]] == int(r["kept"]) for r in rows if r["doc_id"] in known]
    assert sum(right) / len(right) > 0.95
    assert all(r["kept"] for r in rows if known.get(r["doc_id"]) == 1 and r["quality"] > 0.5)


def test_sparse_sites_shrink(spark):
    """A site with one bad row stays near all; one with many bad rows goes down."""
    rows = [("big", "a", 3.0)] * 400 + [("bad", "b", -3.0)] * 300 + [("one", "c", -3.0)] + [(None, None, 3.0)] * 2
    priors, overall = quality_classifier.site_priors(spark.createDataFrame(rows, "host string, path string, odds double"))
    got = {r["host"]: r["prior"] for r in priors.collect()}
    assert got["big"] > 0.9 and got["bad"] < 0.1 and 0.1 < got["one"] < overall and got[None] > overall


def test_classifier_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some words here", None, None, 5), (None, None, "s", "en", 6)], "doc_id bigint, text string, source string, lang string, kept int")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert [r["kept"] for r in quality_classifier.scored(docs, none).collect()] == [True, True]
    assert quality_classifier.scored(docs.limit(0), none).count() == 0


PAGES = [(5, "u", "x" * 200), (3, "u", "x" * 200), (9, None, "y"), (8, "a\r\nb", "y"), (None, "u", "x" * 200), (7, "u", None), (6, "u", ""),
         (11, "u", "WARC/1.1\r\n\r\n0\r\n\r\né" * 3000), (12, "u", "WARC/1.1\r\n\r\n0\r\n\r\né" * 3000), (3, "u", "x" * 200)]


def test_archives_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").selectExpr("*", "1 AS digest", "2 AS number")
    got = sorted(((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in
                  warc.stored_and_read(df, segment=700, size=9000).collect()), key=str)
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if p is not None and (h or "") == (html or "")]
        other = len(data) >= 100 and page != min(same)
        want.append((page or 0, len(data), brute.sha(data), "revisit" if other else "response", min(same) if other else None))
    assert got == sorted(want, key=str)
    assert warc.stored_and_read(df.limit(0)).count() == 0


def test_broken_segments_are_named(spark):
    payload = ("abc" * 900).encode()
    parts = [list(warc.parsed(r[:-1] + b"\n"))[0] for r in warc.records("<r>", "u", None, brute.sha(payload), payload, 500)]

    def rows(chosen):
        return [(h.get("warc-record-id"), h["warc-type"], "u", None, h.get("warc-segment-origin-id"), int(h["warc-segment-number"]),
                 int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, h.get("warc-payload-digest"), b) for h, b in chosen]

    def read(chosen):
        return warc.decoded(warc.reassembled(spark.createDataFrame(rows(chosen), warc.RECORD))).first()

    whole = read(parts[::-1] + parts[1:2])
    assert whole["fault"] is None and bytes(whole["payload"]) == payload
    assert read(parts[1:])["fault"] == "no first segment" and read(parts[:-1])["fault"] == "no last segment"
    assert read(parts[:2] + parts[3:])["fault"] == "segments missing or in conflict"


def test_equal_large_pages_in_many_files(spark, tmp_path):
    """Rows with equal ids, urls and payloads in several tasks stay apart, segments and all."""
    html = "".join(f"<p>{i * 7919 % 10007}</p>" for i in range(7000))
    pages = spark.createDataFrame([(i, f"u{i}", f"{i}{html}") for i in range(40)], "page_id bigint, url string, html string").coalesce(1)
    for copy in range(6):
        pages.write.parquet(str(tmp_path / f"copy={copy}"))
    rows = spark.read.parquet(str(tmp_path)).selectExpr("page_id", "url", "html", "1 AS row", "2 AS page")
    got = warc.stored_and_read(rows).collect()
    assert len(got) == 240 and {r["fault"] for r in got} == {None} and {r["record_type"] for r in got} == {"response"}
    assert {r["payload_bytes"] for r in got if r["page_id"] < 10} == {1 + len(html)} and len({r["payload_digest"] for r in got}) == 40


def test_archives_hold_members_and_continuations(spark, tmp_path):
    """The pages of sf0.01: each record is a gzip member that stands alone, and some are segments."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    path = str(tmp_path / "warc")
    warc.write(warc.archives(warc.marked(pages), size=100_000), path)
    kinds, files = {}, [f.read_bytes() for f in (tmp_path / "warc").glob("part-*")]
    for blob in files:
        assert len(blob) <= 100_000 and gzip.decompress(blob)
        for part in warc.members(blob):
            (headers, _), = warc.parsed(part)
            assert {"warc-date", "warc-record-id", "content-length"} <= set(headers)
            assert headers["warc-type"] == "continuation" or headers["content-type"] == "application/http; msgtype=response"
            kinds[headers["warc-type"]] = kinds.get(headers["warc-type"], 0) + 1
    assert len(files) > 3 and kinds["response"] == 250 and kinds["continuation"] >= 17


def test_archives_of_any_bytes(spark, tmp_path):
    blob = b"".join(warc.member(warc.record([("WARC-Type", "response")], bytes(range(256)) * n)) for n in (1, 0, 40))
    warc.write(spark.createDataFrame([(bytearray(blob),)], "archive binary").coalesce(1), str(tmp_path / "a"))
    assert next((tmp_path / "a").glob("part-*")).read_bytes() == blob
    assert sorted(len(r["block"]) for r in warc.read(spark, str(tmp_path / "a")).collect()) == [0, 256, 10240]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.Workspace(spark).store(stage(spark, docs, FOLDER), "stage")
        seen[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert name == "byte-level bpe" or docs.columns == before.columns
    sizes = [len(x) for x in seen.values()]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    first = {r["doc_id"]: r["text"] for r in documents(spark)}
    ids = sorted(seen["quality classifier"])
    groups = brute.components([brute.fingerprint(first[i]) for i in ids], ids)
    assert seen["simhash near-dedup"] == set(groups)
    assert corpus_pipeline.run(spark, FOLDER).count() == sizes[-1]


def test_stages_with_odd_rows(spark):
    text = "some ordinary words that make a sentence of a fair length for the classifier to keep"
    rows = [(None, text, None, None, 3, 1), (None, text, "en", "s", None, 2), (4, text + " token=abcdefgh12", "en", "s", 9, 3), (4, None, "en", "s", 0, 4), (5, "", None, "s", 0, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, quality int")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() <= len(rows)
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    clean = corpus_pipeline.secrets(spark, docs, FOLDER).where(F.col("quality") == 3).first()
    assert clean["text"].endswith("[SECRET]") and clean["n_chars"] == len(clean["text"])
