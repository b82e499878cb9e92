"""The ledger kept between runs, key blocks, clashing names and odd tables of the secret scans."""

import re

import pytest
from pyspark.sql import functions as F

from covista.llm import secret_scans
from covista.llm.queries import QUERIES, SQL
from covista.plans import scratch_path
from tests.oracle import connection, difference

FOLDER = "/root/testdata/sf0.001"
RULES = secret_scans.BASE_RULES + secret_scans.MORE_RULES
KEY = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n" + "QUJDREVG/+\n" * 3000 + "-----END RSA PRIVATE KEY-----"
TEXTS = [f"a {KEY} b {KEY}", "-----BEGIN PRIVATE KEY-----\nAAAA\n-----END RSA PRIVATE KEY-----", "-----BEGIN EC PRIVATE KEY-----" + "-x" * 60000,
         "-----BEGIN PRIVATE KEY-----" * 2000, "é😀 " + KEY, "eyJabcdefgh.eyJabcdefgh.x eyJabcdefg.eyJabcdefgh.x", "", None, "plain", "plain"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def pairs(df):
    return sorted((bytes(r["blob"]), r["rule"], tuple(map(tuple, r["spans"]))) for r in df.collect())


def test_a_second_run_scans_nothing(spark):
    root = scratch_path(spark, "ledger")
    first = secret_scans.update_ledger(frame(spark, TEXTS), RULES, root)
    known = pairs(first)
    assert len(known) == len({t or "" for t in TEXTS}) * len(RULES)
    assert secret_scans.scan_new(frame(spark, TEXTS), RULES, first).count() == 0
    assert pairs(secret_scans.update_ledger(frame(spark, TEXTS), RULES, root)) == known
    newer = (*RULES[:2], secret_scans.Rule("hex", "[0-9a-f]+", 0, 40, version=2))
    grown = secret_scans.update_ledger(frame(spark, ["plain", "new"]), newer, root)
    added = [(b, rule) for b, rule, _ in pairs(grown) if (b, rule) not in {k[:2] for k in known}]
    assert sorted(rule for _, rule in added) == ["access@1", "assign@1", "hex@2", "hex@2"]


def test_an_incomplete_batch_does_not_count(spark):
    root = scratch_path(spark, "ledger")
    assert secret_scans.read_ledger(spark, root) is None
    spark.range(3).write.parquet(f"{root}/{secret_scans.BATCH}00000001")
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = jvm.Path(f"{root}/{secret_scans.BATCH}00000001/_SUCCESS")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
    assert secret_scans.read_ledger(spark, root) is None
    assert secret_scans.update_ledger(frame(spark, ["plain"]), RULES, root).count() == len(RULES)


@pytest.mark.parametrize("kind", ["pem", "jwt"])
def test_further_rules_against_brute_force(spark, kind):
    rule = next(r for r in RULES if r.kind == kind)
    found = secret_scans.with_findings(frame(spark, TEXTS), secret_scans.scan_new(frame(spark, TEXTS), (rule,)), (rule,))
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["findings"]] for r in found.collect()}
    assert got == {k: [m.span() for m in re.finditer(rule.pattern, t or "")] for k, t in enumerate(TEXTS)}
    assert any(got.values())


def test_a_key_block_is_removed_whole(spark):
    df = frame(spark, TEXTS)
    found = secret_scans.with_findings(df, secret_scans.scan_new(df, RULES), RULES)
    clean = [r["t"] for r in found.orderBy("doc_id").select(secret_scans.redacted(F.col("text"), F.col("findings")).alias("t")).collect()]
    assert clean[0] == "a [SECRET] b [SECRET]" and clean[4] == "é😀 [SECRET]" and clean[7] is None


def test_clashing_names_and_empty_tables(spark):
    names = ["blob", "own_blob", "_own_blob", "rule", "spans", "due", "seen", "pair", "part", "Blob_"]
    df = frame(spark, TEXTS).select("*", *[F.lit(n).alias(n) for n in names])
    found = secret_scans.with_findings(df, secret_scans.scan_new(df, RULES), RULES)
    assert found.columns == [*df.columns, "findings"] and found.count() == len(TEXTS)
    assert all(r[n] == n for r in found.collect() for n in names)
    empty, root = df.limit(0), scratch_path(spark, "ledger")
    ledger = secret_scans.update_ledger(empty, RULES, root)
    assert ledger.count() == 0 and secret_scans.with_findings(empty, ledger, RULES).count() == 0
    assert {len(r["findings"]) for r in secret_scans.with_findings(df, ledger, RULES).collect()} == {0}


def test_runs_over_one_ledger(spark):
    assert difference(QUERIES["secret_ledger_runs"](spark, FOLDER), connection(FOLDER), SQL["secret_ledger_runs"]) is None
