"""Quality by hierarchical empirical Bayes: a document's own evidence, shrunk site priors.

A logistic classifier over a few plain measures gives each document log odds of being good. Sites are
seen at two levels: a host and a path within it. The share of good documents of a host is its mean
probability shrunk towards that of all documents; that of a path is shrunk towards its host. How strongly
(in documents) follows from how much sites of the level really differ (method of moments over all sites).
The final odds are the document's odds times the odds of its path, relative to all documents.

The classifier may be fitted on a bounded sample of labelled rows (``SAMPLE``); all else covers all rows.
Null hosts and paths are sites of their own. Null and empty texts have the measures of an empty text.
Labels that are null or without a document are ignored; without any of both classes all odds are even.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.llm.quality_rules import SPACES, SYMBOLS, bound
from covista.plans import Workspace

# labelled rows that the classifier is fitted on, at most; those with the smallest hash of their id
SAMPLE = 20_000
RIDGE = 0.05
# a document goes below this probability
LEAST = 0.5
MEASURES = ("repeats", "symbols", "shouts", "capitals", "word_size", "again", "bars", "length")


def measured(text: Column) -> Column:
    """Struct of the measures of a text, all between 0 and about 1."""
    value = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(value, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def rates(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1))
        chars = F.length(F.translate(value, SPACES, ""))
        upper = F.length(value) - F.length(F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
        after = F.slice(w, 2, F.size(w))
        repeats = F.size(F.filter(F.zip_with(w, after, lambda a, b: a == b), lambda same: same))

        def count(chars: str) -> Column:
            return F.length(value) - F.length(F.translate(value, chars, ""))

        return F.struct(
            (repeats / n).alias("repeats"), F.least(count(SYMBOLS) / n, F.lit(2.0)).alias("symbols"),
            F.least(count("!?") / n, F.lit(2.0)).alias("shouts"), (upper / F.greatest(chars, F.lit(1))).alias("capitals"),
            F.least(chars / n / 20, F.lit(2.0)).alias("word_size"), (1 - F.size(F.array_distinct(w)) / n).alias("again"),
            F.least(count("|") / n, F.lit(2.0)).alias("bars"), (F.log1p(F.size(w)) / 12).alias("length"))

    return bound(words, rates)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        return w
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE) -> np.ndarray:
    """Weights of the classifier from at most ``sample`` labelled rows."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    chosen = known.orderBy(F.xxhash64("_key"), "_key", "_label").limit(sample)
    chosen = F.broadcast(chosen)  # at most ``sample`` ids and labels
    rows = (docs.join(chosen, docs[key] == chosen["_key"]).select(measured(F.col(text)).alias("m"), "_label")
            .select(*[F.col(f"m.{c}") for c in MEASURES], "_label").toPandas())
    return fit(rows[list(MEASURES)].to_numpy(dtype=float).reshape(-1, len(MEASURES)), rows["_label"].to_numpy(dtype=float))


def evidence(text: Column, weights: np.ndarray) -> Column:
    """Log odds of a text, between -10 and 10."""
    terms = bound(measured(text), lambda m: sum((m[c] * float(w) for c, w in zip(MEASURES, weights)), F.lit(float(weights[-1]))))
    return F.least(F.greatest(terms, F.lit(-10.0)), F.lit(10.0))


def log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(sites: DataFrame, share: Column, above: Column) -> float:
    """Documents that the prior of a level is worth: large when sites differ no more than chance.

    Moments over all sites: the spread of their shares around the level above, less what sampling
    explains, is the true variance v; a beta prior of mean m has strength m(1-m)/v - 1.
    """
    row = sites.agg(F.sum("n").alias("n"), F.sum(F.col("n") * above * (1 - above)).alias("within"),
                    F.sum(F.col("n") * (share - above) ** 2).alias("between"), F.count("*").alias("sites")).first()
    if not row["n"] or row["sites"] < 2:
        return 1e3
    mean = row["within"] / row["n"]
    true = row["between"] / row["n"] - row["sites"] / row["n"] * mean
    return float(np.clip(mean / true - 1, 1.0, 1e3)) if true > 0 else 1e3


def site_priors(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, prior) from (host, path, odds), and the share of good documents."""
    p = 1 / (1 + F.exp(-F.col("odds")))
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("good"))
    work = Workspace(scored.sparkSession)
    paths = work.store(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = min(max((total["good"] or 0.0) / (total["n"] or 1), 0.01), 0.99)
    s = strength(hosts, F.col("good") / F.col("n"), F.lit(overall))
    hosts = hosts.select(F.col("host").alias("_host"), ((F.col("good") + s * overall) / (F.col("n") + s)).alias("above"))
    placed = work.store(paths.join(hosts, paths["host"].eqNullSafe(hosts["_host"])).drop("_host"), "placed")
    work.drop(paths)
    t = strength(placed, F.col("good") / F.col("n"), F.col("above"))
    prior = (F.col("good") + t * F.col("above")) / (F.col("n") + t)
    return placed.select("host", "path", F.least(F.greatest(prior, F.lit(0.01)), F.lit(0.99)).alias("prior")), overall


def scored(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", text: str = "text", key: str = "doc_id",
           least: float = LEAST, sample: int = SAMPLE, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all if not given) with quality (a probability), site_prior and kept.

    Evidence is taken once and stored with the columns, as measuring texts is the costly part.
    """
    weights = train(docs, labels, key, text, sample=sample)
    work = Workspace(docs.sparkSession)
    columns = docs.columns if columns is None else columns
    extra = [c for c in (host, path) if c not in columns]
    docs = work.store(docs.select(*columns, *extra, evidence(F.col(text), weights).alias("_odds")), "evidence")
    odds = F.col("_odds")
    priors, overall = site_priors(docs.select(F.col(host).alias("host"), F.col(path).alias("path"), odds.alias("odds")))
    priors = priors.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("prior").alias("site_prior"))
    docs = docs.drop("quality", "site_prior", "kept")
    total = odds + log_odds(F.col("site_prior")) - float(np.log(overall / (1 - overall)))
    return (docs.join(priors, docs[host].eqNullSafe(priors["_host"]) & docs[path].eqNullSafe(priors["_path"]))
            .withColumn("quality", 1 / (1 + F.exp(-total))).withColumn("kept", F.col("quality") >= least)
            .drop("_host", "_path", "_odds", *extra))
