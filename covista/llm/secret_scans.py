"""Secret scans over content-addressed blobs, with a ledger of what was scanned.

Every version of a text is known by the SHA-256 of its bytes. The ledger has a row for each blob and
rule version that was scanned, with the spans found, so that a later call scans only what is new:
unseen blobs by all rules, seen blobs by new rule versions. Findings are joined back to every path that
holds the blob. DataFrame functions only.

A kept ledger is a folder of batches, one a call, partitioned by rule; a batch counts only once it is
whole, so a call that was lost midway is simply made again. ``update_ledger`` joins digests with the
ledger first and fetches the texts of due blobs after that, so that old texts are hashed and no more.

Spans are code points, end exclusive. A null text counts as empty. Rows are never merged: repeated rows
and repeated ids each get their findings, and their blob is scanned once. Rules match leftmost and
without overlap, each by itself; equal starts are ordered by the place of the rule. An empty table makes
an empty batch and no findings. Texts are scanned whole, whatever their length. Further columns pass
through under any name; only a column of the name asked for the findings is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covista.sources.tables import complete_versions

SPANS = "array<struct<start:int,end:int>>"
LEDGER = f"blob binary, rule string, spans {SPANS}"
BATCH = "batch="


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping; those whose ``group`` is shorter than
    ``least`` characters are dropped. Changing a rule means a new ``version``."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules, in their order.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
# Further rules, after the base ones. A key block goes to its END line where it has one;
# header lines of a block hold a few single dashes, its body none.
MORE_RULES = (
    Rule("pem", r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----(?:[^-]*+(?:-[^-]++){0,16}+-----END \1PRIVATE KEY-----)?", version=2),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)


def _quick(rule: Rule) -> str:
    """A cheaper pattern that finds something wherever the rule does."""
    return f"{rule.pattern[:-1]}{{{rule.least},}}" if rule.pattern == "[0-9a-f]+" else rule.pattern


def spans(text: Column, rule: Rule) -> Column:
    """Spans of a rule: what lies between matches gives their places."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
    sizes = F.arrays_zip(F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
                         F.transform(hits, F.length).alias("hit"), F.transform(checked, F.length).alias("value"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))

    def step(seen: Column, size: Column) -> Column:
        start = seen["at"] + size["gap"]
        end = start + F.coalesce(size["hit"], F.lit(0))
        found = F.when(size["value"] >= rule.least, F.concat(
            seen["found"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(seen["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    walked = F.aggregate(sizes, empty, step, lambda seen: seen["found"])
    return F.when(text.rlike(_quick(rule)), walked).otherwise(F.array().cast(SPANS))


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _due(digests: DataFrame, ledger: DataFrame, names: list[str]) -> DataFrame:
    """(blob, due): the rules that the ledger lacks, for the blobs that miss one."""
    seen = (ledger.where(F.col("rule").isin(names)).groupBy("blob")
            .agg(F.collect_set("rule").alias("seen")))  # at most one row per rule
    every = F.array(*[F.lit(n) for n in names])
    return (digests.join(seen, "blob", "left")
            .select("blob", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))).alias("due"))
            .where(F.size("due") > 0))


def scan_new(docs: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None = None,
             text: str = "text") -> DataFrame:
    """Ledger rows (blob, rule, spans) for the pairs that the ledger lacks. Each new blob is scanned
    once, however many paths or versions hold it."""
    names = [r.name for r in rules]
    blobs = docs.select(blob_of(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if ledger is None:
        blobs = blobs.withColumn("due", F.array(*[F.lit(n) for n in names]))
    else:
        blobs = blobs.join(_due(blobs.select("blob").distinct(), ledger, names), "blob")
    scanned = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.when(
        F.array_contains("due", r.name), spans(F.col("text"), r)).alias("spans")) for r in rules])
    return (blobs.dropDuplicates(["blob"]).select("blob", F.explode(scanned).alias("pair"))
            .select("blob", "pair.rule", "pair.spans").where(F.col("spans").isNotNull()))


def read_ledger(spark: SparkSession, root: str) -> DataFrame | None:
    """All whole batches of the ledger kept under ``root``; None before the first."""
    batches = complete_versions(spark, root, BATCH, "_SUCCESS")
    if not batches:
        return None
    root = root.rstrip("/")
    rows = spark.read.schema(LEDGER).option("basePath", root).parquet(*[f"{root}/{b}" for b in batches])
    return rows.select("blob", "rule", "spans")


def update_ledger(docs: DataFrame, rules: tuple[Rule, ...], root: str, text: str = "text") -> DataFrame:
    """Scan what the ledger under ``root`` lacks, append it as a batch, give the whole ledger.

    One writer at a time. Rules of other versions stay in the ledger; those who read it name theirs.
    """
    spark, root = docs.sparkSession, root.rstrip("/")
    batches = complete_versions(spark, root, BATCH, "_SUCCESS")
    number = int(batches[-1].removeprefix(BATCH)) + 1 if batches else 1
    fresh = scan_new(docs, rules, read_ledger(spark, root), text)
    (fresh.write.mode("overwrite")  # of a batch that a lost call left incomplete
     .option("compression", "zstd").partitionBy("rule").parquet(f"{root}/{BATCH}{number:08d}"))
    return read_ledger(spark, root)


def _unused(name: str, taken: list[str]) -> str:
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def with_findings(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...], text: str = "text",
                  name: str = "findings") -> DataFrame:
    """``docs`` with an array of (start, end, kind, place of the rule), ordered by start, then rule."""
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    kinds = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.kind))])
    found = (ledger.where(F.col("rule").isin([r.name for r in rules]) & (F.size("spans") > 0))
             .select("blob", F.transform("spans", lambda s: F.struct(
                 s["start"].alias("start"), place[F.col("rule")].alias("place"), s["end"].alias("end"),
                 kinds[F.col("rule")].alias("kind"))).alias("part"))
             .groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("part"))).alias(name)))
    kind = found.schema[name].dataType
    # the digest is a column of its own, so that texts move only where they are asked for
    docs = docs.drop(name)
    own = _unused("own_blob", [*docs.columns, name])
    theirs = _unused("blob", [*docs.columns, name, own])
    found = found.withColumnRenamed("blob", theirs)
    return (docs.withColumn(own, blob_of(F.col(text))).join(found, F.col(own) == F.col(theirs), "left").drop(own, theirs)
            .withColumn(name, F.coalesce(F.col(name), F.array().cast(kind))))


def redacted(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by a mark; overlapping spans give one mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        more = F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit(mark))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(fresh, more).otherwise(done["out"]).alias("out"))

    whole = F.aggregate(findings, start, step, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    return F.when(F.size(findings) > 0, whole).otherwise(text)


def count_of(findings: str, rule: Rule) -> Column:
    return F.size(F.filter(findings, lambda s: s["kind"] == rule.kind)).cast("long")


def joined(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
