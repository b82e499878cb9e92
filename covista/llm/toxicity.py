"""Toxicity by a classifier that identity terms may not sway.

Features are the words of a text and the beginnings of longer words (4 and 5 letters), present or not. The model is
fitted on a bounded sample of the labelled rows, whose ids are chosen before any text is read. The features kept are
those whose frequency differs between the labels by more than chance, and all names of groups with their beginnings.

The loss of the logistic model has the squared changes of the log odds under counterfactuals of the sample's sentences: in a
sentence that names a group the name is swapped for every other of its language's list; into a sentence that names none
every name is put. A name gets so no weight of its own, however often it stands in toxic rows, and neither does a
beginning that it shares with other words. Changes are counted over all sentences and names; their number does not grow
with the sample, as a change depends on the features of two names only.

Only the text is an input of a score. Null and empty texts get the score of a text without any feature; long ones are
read whole. Labels that are null, or without a document, are ignored; without both labels every score is 0. Of rows with
equal ids, and of labels for one id, training takes one (the least). Ties in the choice of the sample go to the smaller id.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.plans import Workspace

# Neutral names of groups that may stand for each other, by language.
IDENTITIES = (
    ("women", "men", "muslims", "christians", "jews", "immigrants", "gays", "lesbians", "blacks", "whites", "asians"),
    ("woman", "man", "muslim", "christian", "jewish", "immigrant", "gay", "lesbian", "black", "white", "asian"),
    ("frauen", "männer", "muslime", "christen", "juden", "einwanderer", "schwule", "lesben", "schwarze", "weiße"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "gays", "lesbiennes", "noirs", "blancs"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "gays", "lesbianas", "negros", "blancos"),
)
SWAPS = {term: tuple(t for t in group if t != term) for group in reversed(IDENTITIES) for term in group}
NAMES = tuple(sorted({t for group in IDENTITIES for t in group}))
# rows the model is fitted on, at most, of each label
SAMPLE = 8_000
# standard errors by which a feature's frequencies must differ
CHANCE = 6.0
RIDGE, FAIRNESS, ROUNDS = 0.02, 10.0, 60
THRESHOLD = 0.3

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")


def features(words) -> set[str]:
    """Words, and beginnings of longer words."""
    out = set(words)
    out |= {f"{w[:4]}*" for w in out if len(w) > 4} | {f"{w[:5]}*" for w in out if len(w) > 5}
    return out


def features_of(text: str | None) -> set[str]:
    return features(WORD.findall((text or "").lower()))


def name_features(known: set[str]) -> dict[str, frozenset[str]]:
    """The features of each name that are among the known ones."""
    return {name: frozenset(features([name]) & known) for name in NAMES}


def changes(text: str | None, names: dict[str, frozenset[str]]) -> Counter:
    """How often each change (features gained, features lost) occurs over the counterfactuals of a text's sentences."""
    out: Counter = Counter()
    for sentence in SENTENCE.findall((text or "").lower()):
        words = WORD.findall(sentence)
        if not words:
            continue
        at = [k for k, w in enumerate(words) if w in SWAPS]
        if not at:
            own = features(words)
            for name, new in names.items():
                out[(new - own, frozenset())] += 1
        for k in at:
            rest = features([*words[:k], *words[k + 1:]])
            for other in SWAPS[words[k]]:
                gained, lost = names[other] - rest, names[words[k]] - rest
                out[(gained - lost, lost - gained)] += 1
    out.pop((frozenset(), frozenset()), None)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int) -> DataFrame:
    """(id, text, label) of the sample: of each label the ``sample`` first rows by hash of the id, of those whose crc32 of
    the id, mod 4, is not 2. Ids are chosen first, from the two columns of ids; texts are then met by at most twice
    ``sample`` ids, which is small enough to be sent to every task, so texts of other rows do not move."""
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    known = (labels.select(F.col(key).alias("id"), F.col(label).alias("label")).where(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
             .groupBy("id").agg(F.min("label").alias("label")))
    present = known.join(docs.select("id"), "id", "left_semi")
    order = (F.xxhash64("id"), "id")
    first, second = (present.where(F.col("label") == c).orderBy(*order).limit(sample) for c in (0, 1))
    return docs.join(F.broadcast(first.unionAll(second)), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def held_out(key):
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def chosen_features(rows: DataFrame) -> list[str]:
    """The features that tell the labels apart in the sample, and those of names."""

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        return pa.array((sorted(features_of(t.as_py())) for t in texts), pa.list_(pa.string()))

    sizes = rows.agg(F.sum("label").alias("toxic"), F.count("*").alias("all")).first()
    toxic, clean = sizes["toxic"] or 0, (sizes["all"] or 0) - (sizes["toxic"] or 0)
    if not toxic or not clean:
        return []
    counted = rows.select(F.explode(found("text")).alias("feature"), "label").groupBy("feature").agg(
        F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    p, q, r = F.col("t") / toxic, F.col("c") / clean, (F.col("t") + F.col("c")) / (toxic + clean)
    apart = (p - q) / F.sqrt(r * (1 - r) * (1 / toxic + 1 / clean))
    best = counted.where((F.col("t") + F.col("c") >= 5) & (r < 1) & (F.abs(apart) > CHANCE))
    return sorted({x["feature"] for x in best.select("feature").collect()} | features(NAMES))  # bounded by the sample


class Sparse:
    """A matrix of zeros and a few other values."""

    def __init__(self, rows: list[int], columns: list[int], values: list[float], shape: tuple[int, int]):
        self.rows, self.columns, self.values, self.shape = np.array(rows, dtype=np.int64), np.array(columns, dtype=np.int64), np.array(values, dtype=float), shape

    def times(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * v[self.columns], self.shape[0])

    def turned_times(self, u: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, self.values * u[self.rows], self.shape[1])


def fit(x: Sparse, y: np.ndarray, change: Sparse, often: np.ndarray, fairness: float = FAIRNESS) -> np.ndarray:
    """Weights (the last is the constant) of the logistic model with a ridge and the penalty on the mean squared
    change of log odds; Newton steps, each solved by conjugate gradients."""
    n = x.shape[1]
    share = fairness * often / max(often.sum(), 1.0) * x.shape[0] / 100
    ridge = np.append(np.full(n, RIDGE), 1e-6)

    def held(v: np.ndarray) -> np.ndarray:
        return ridge * v + np.append(change.turned_times(share * change.times(v[:-1])), 0.0)

    w = np.zeros(n + 1)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x.times(w[:-1]) + w[-1], -30, 30)))
        d = p * (1 - p)
        rest = np.append(x.turned_times(y - p), (y - p).sum()) - held(w)

        def curved(v: np.ndarray, d: np.ndarray = d) -> np.ndarray:
            u = d * (x.times(v[:-1]) + v[-1])
            return np.append(x.turned_times(u), u.sum()) + held(v)

        step, r = np.zeros(n + 1), rest.copy()
        way, size = r.copy(), r @ r
        least = 1e-16 * size
        for _ in range(10 * (n + 1)):
            if size <= least:
                break
            bent = curved(way)
            a = size / (way @ bent)
            step += a * way
            r -= a * bent
            size, before = r @ r, size
            way = r + size / before * way
        w += step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = SAMPLE, fairness: float = FAIRNESS) -> dict[str, float]:
    """Weight of each feature; that of the empty string is the constant."""
    work = Workspace(docs.sparkSession)
    rows = work.store(training_rows(docs, labels, key, text, label, sample), "training")
    kept = chosen_features(rows)
    if not kept:
        work.drop(rows)
        return {"": -20.0}
    number = {f: i for i, f in enumerate(kept)}
    names = name_features(set(kept))

    @F.arrow_udf("array<int>")
    def own(texts: pa.Array) -> pa.Array:
        return pa.array((sorted(number[f] for f in features_of(t.as_py()) if f in number) for t in texts), pa.list_(pa.int32()))

    @F.arrow_udf("array<struct<gained:array<int>,lost:array<int>,n:bigint>>")
    def changed(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("gained", pa.list_(pa.int32())), ("lost", pa.list_(pa.int32())), ("n", pa.int64())]))
        return pa.array(([{"gained": sorted(map(number.get, a)), "lost": sorted(map(number.get, b)), "n": n} for (a, b), n in changes(t.as_py(), names).items()]
                         for t in texts), kind)

    found = rows.select("label", own("text").alias("own")).collect()  # bounded by the sample
    moved = (rows.select(F.explode(changed("text")).alias("c")).groupBy("c.gained", "c.lost").agg(F.sum("c.n").alias("n"))
             .collect())  # bounded by pairs of names
    work.drop(rows)
    x = Sparse([i for i, r in enumerate(found) for _ in r["own"]], [j for r in found for j in r["own"]], [1.0] * sum(len(r["own"]) for r in found),
               (len(found), len(kept)))
    change = Sparse([i for i, r in enumerate(moved) for _ in (*r["gained"], *r["lost"])], [j for r in moved for j in (*r["gained"], *r["lost"])],
                    [v for r in moved for v in [1.0] * len(r["gained"]) + [-1.0] * len(r["lost"])], (len(moved), len(kept)))
    w = fit(x, np.array([r["label"] for r in found], dtype=float), change, np.array([r["n"] for r in moved], dtype=float), fairness)
    return {"": float(w[-1])} | {f: float(v) for f, v in zip(kept, w)}


def score_of(found: set[str], weights: dict[str, float]) -> float:
    odds = weights[""] + math.fsum(weights[f] for f in found & weights.keys())
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def gap(weights: dict[str, float], sentences: list[str]) -> float:
    """The largest difference between scores of a sentence with one name and with another put at its end."""
    out = 0.0
    for sentence in sentences:
        scores = [score_of(features_of(f"{sentence} {name}"), weights) for name in NAMES]
        out = max(out, max(scores) - min(scores))
    return out


def scorer(sent: Broadcast):
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array((score_of(features_of(t.as_py()), sent.value) for t in texts), pa.float64())

    return score


def scored(docs: DataFrame, weights: dict[str, float], text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability that the label is 1."""
    score = scorer(docs.sparkSession.sparkContext.broadcast(weights))  # bounded by the sample
    return docs.withColumn(name, score(F.col(text)))
