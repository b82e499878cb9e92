"""The operators of this folder as queries over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covista.llm import (bottom_k, bpe, collocations, decontaminate, hard_negatives, licences, quality_classifier, quality_rules,
                         secret_scans, simhash, substrings, toxicity, warc)
from covista.plans import Workspace, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (session, folder) -> DataFrame under its own name, with equal SQL if there is."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.best_licence(table(spark, folder, "documents").select("doc_id", "text"))


@query("""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), q AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
         min(page_id) OVER (PARTITION BY html) AS first FROM p), r AS (
  SELECT *, payload_bytes >= 100 AND page_id > first AS again FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to, CAST(NULL AS VARCHAR) AS fault FROM r""")
def op2_warc_segments(spark: SparkSession, folder: str) -> DataFrame:
    return warc.stored_and_read(table(spark, folder, "pages"))


def _level(name: str, keys: str) -> str:
    """Quartile buckets of each measure per key."""
    by = f"PARTITION BY {keys}, measure" if keys else "PARTITION BY measure"
    keys = f"{keys}, " if keys else ""
    return f"""{name} AS (
  SELECT {keys}measure, max(whole) AS n, min(bucket) FILTER (upto * 4 >= whole) AS q1, min(bucket) FILTER (upto * 4 >= whole * 3) AS q3
  FROM (SELECT {keys}measure, bucket, sum(count(*)) OVER ({by} ORDER BY bucket) AS upto, sum(count(*)) OVER ({by}) AS whole
        FROM cut GROUP BY {keys}measure, bucket) GROUP BY {keys}measure)"""


def _fence(measure: str, sign: str, slack: int) -> str:
    quarter = "q3" if sign == "+" else "q1"
    return f"max(CASE WHEN measure = '{measure}' THEN CAST({quarter} {sign} 6.0 * (q3 - q1) {sign} {slack} AS DOUBLE) END)"


HIGH = {f.measure: f.slack for f in quality_rules.FENCES}
QUALITY_SQL = r"""WITH texts AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM texts WHERE len(words) >= 5),
repeats AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i + 4]) AS n FROM windows),
covers AS (SELECT doc_id, count(DISTINCT i + s) AS n FROM repeats, generate_series(0, 4) AS g(s) WHERE n > 1 GROUP BY 1),
counts AS (
  SELECT t.doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(c.n, 0) AS n_repeat_words,
         length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         length(x) - length(regexp_replace(x, '[!?]', '', 'g')) AS n_shouts
  FROM texts t LEFT JOIN covers c ON c.doc_id = t.doc_id),
rates AS (
  SELECT *, n_symbols * 1000 // greatest(n_words, 1) AS symbol_rate, word_chars * 100 // greatest(n_words, 1) AS word_size,
         n_dup_lines * 1000 // greatest(n_lines, 1) AS dup_line_rate, n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_rate,
         n_shouts * 1000 // greatest(n_words, 1) AS shout_rate FROM counts),
cells AS (""" + " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {m} AS v FROM rates" for m in HIGH) + """),
cut AS (SELECT lang, source, measure, v - v % (1::BIGINT << greatest(length(bin(v)) - 6, 0)) AS bucket FROM cells),
""" + ",\n".join((_level("own", "lang, source"), _level("tongue", "lang"), _level("everyone", ""))) + """,
picked AS (
  SELECT o.lang, o.source, o.measure, CASE WHEN o.n >= 100 THEN o.q1 WHEN t.n >= 100 THEN t.q1 ELSE e.q1 END AS q1,
         CASE WHEN o.n >= 100 THEN o.q3 WHEN t.n >= 100 THEN t.q3 ELSE e.q3 END AS q3
  FROM own o JOIN tongue t ON t.lang IS NOT DISTINCT FROM o.lang AND t.measure = o.measure JOIN everyone e ON e.measure = o.measure),
limits AS (SELECT lang, source, """ + ", ".join(f"{_fence(m, '+', s)} AS {m}_high" for m, s in HIGH.items()) + f""",
         {_fence('word_size', '-', HIGH['word_size'])} AS word_size_low FROM picked GROUP BY 1, 2),
judged AS (SELECT r.*, l.* EXCLUDE (lang, source), n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed
  FROM rates r JOIN limits l ON l.lang IS NOT DISTINCT FROM r.lang AND l.source IS NOT DISTINCT FROM r.source)
SELECT * EXCLUDE (lang, source, {', '.join(HIGH)}), NOT base_failed AND word_size >= word_size_low AND """ + " AND ".join(
    f"{m} <= {m}_high" for m in HIGH) + " AS kept FROM judged"


@query(QUALITY_SQL)
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    counted = Workspace(spark).store(quality_rules.counts(docs).drop("text"), "quality-counts")
    return quality_rules.judged(counted).drop("lang", "source")


@query(r"""WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents), windows AS (
  SELECT doc_id, words, unnest(generate_series(1, len(words) - 34)) AS start FROM texts WHERE len(words) >= 35), repeats AS (
  SELECT doc_id, start, count(*) OVER (PARTITION BY array_to_string(words[start:start + 34], ' ')) AS n FROM windows), gone AS (
  SELECT DISTINCT doc_id, start + step AS place FROM repeats, generate_series(0, 34) AS s(step) WHERE n > 1), placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts), kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.place) FILTER (g.place IS NULL) AS line, count(g.place) AS n_removed
  FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.place = p.place GROUP BY 1)
SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id""")
def op4_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(table(spark, folder, "documents").select("doc_id", "text"), size=35)


def rank_file() -> dict[str, str]:
    import public_tokenizers

    return {"path": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def token_digests(df: DataFrame, *columns: str) -> DataFrame:
    return bpe.tokenized(df, **rank_file()).select(
        *columns, (F.length("token_ids") / 4).cast("long").alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")


@query()
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, folder, "benchmark"))


@query()
def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    return quality_classifier.scored(docs, table(spark, folder, "labels"), columns=["doc_id"])


@query()
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), words=3, distance=3)


@query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.scored(docs, weights).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query()
def op10_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules = secret_scans.BASE_RULES + secret_scans.MORE_RULES
    ledger = secret_scans.update_ledger(docs, rules, scratch_path(spark, "ledger"))
    found = secret_scans.with_findings(docs, ledger, rules)
    base = F.filter("findings", lambda s: s["place"] < len(secret_scans.BASE_RULES))
    return found.select(
        "doc_id",
        *[secret_scans.count_of("findings", r).alias(f"n_{r.kind}") for r in secret_scans.BASE_RULES],
        F.sha2(secret_scans.joined(base).cast("binary"), 256).alias("base_sha256"),
        secret_scans.joined(F.col("findings")).alias("spans"))


@query("""WITH blobs AS (SELECT count(DISTINCT coalesce(text, '')) AS n FROM documents)
SELECT 1 AS run, unnest(['access@1', 'assign@1', 'hex@1']) AS rule, n AS blobs FROM blobs
UNION ALL SELECT 2, unnest(['jwt@1', 'pem@2']), n FROM blobs""")
def secret_ledger_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs scanned by three runs over one kept ledger: base rules, all rules, all rules again (none are left)."""
    docs = table(spark, folder, "documents").select("text")
    root, runs = scratch_path(spark, "ledger"), []
    for rules in (secret_scans.BASE_RULES, secret_scans.BASE_RULES + secret_scans.MORE_RULES,
                  secret_scans.BASE_RULES + secret_scans.MORE_RULES):
        secret_scans.update_ledger(docs, rules, root)
        runs.append(f"{root}/{secret_scans.BATCH}{len(runs) + 1:08d}")
    rows = [spark.read.schema(secret_scans.LEDGER).parquet(path).select(F.lit(k).alias("run"), "rule")
            for k, path in enumerate(runs, 1)]
    return rows[0].unionAll(rows[1]).unionAll(rows[2]).groupBy("run", "rule").agg(F.count("*").alias("blobs"))


def _sizes(column: str) -> str:
    return " UNION ALL ".join(f"SELECT lang, {m} AS size, {column.format(m=m)} AS phrase FROM places WHERE pos + {m - 1} <= len(words)" for m in range(1, 5))


@query(r"""WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
places AS (SELECT lang, words, unnest(generate_series(1, len(words))) AS pos FROM lists),
phrases AS (SELECT lang, size, phrase, count(*) AS n FROM (""" + _sizes("words[pos:pos + {m} - 1]") + """) GROUP BY 1, 2, 3),
sizes AS (SELECT lang, sum(n)::BIGINT AS n FROM phrases WHERE size = 1 GROUP BY 1),
candidates AS (SELECT lang, size, phrase, n AS a FROM phrases WHERE size > 1 AND n >= 30),
parts AS (SELECT c.lang, c.phrase, k, x.n AS l, y.n AS r, (2000000::HUGEINT * a) // (x.n::HUGEINT + y.n) AS score
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM candidates) c
  JOIN phrases x ON x.lang = c.lang AND x.phrase = c.phrase[1:k] JOIN phrases y ON y.lang = c.lang AND y.phrase = c.phrase[k + 1:c.size]),
weakest AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, size, phrase, a, unnest(generate_series(2, size - 1)) AS m FROM candidates WHERE size > 2),
inside AS (SELECT lang, a, phrase[s:s + m - 1] AS part FROM (SELECT *, unnest(generate_series(1, size - m + 1)) AS s FROM longer)),
dropped AS (SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inside i ON i.lang = c.lang AND i.part = c.phrase WHERE 100 * i.a >= 80 * c.a),
named AS (SELECT c.lang, array_to_string(c.phrase, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM candidates c JOIN weakest w
  ON w.lang = c.lang AND w.phrase = c.phrase ANTI JOIN dropped d ON d.lang = c.lang AND d.phrase = c.phrase),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""")
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents").select("lang", "text"))


@query("""WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""")
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.mined(rows, F.col("id") % 100 == 0)


@query(r"""WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(generate_series(1, len(words) - 4), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS items FROM texts),
items AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS m, b.n AS n, count(*) AS shared FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * shared >= 85 * (m + n - shared)),
reached(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
lowest AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, len(items)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN lowest ON a = doc_id""")
def op13_bottom_k(spark: SparkSession, folder: str) -> DataFrame:
    return bottom_k.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
