"""Toxicity by a linear classifier that is regularised with counterfactuals.

A text's features are its words and their beginnings, present or not. In every labelled text the
identity terms are swapped for others of their kind; the fit penalises the squared change of the
score under the swap, so that naming a group does not by itself raise a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stored

#: Labelled rows of each class that a fit takes, features it keeps, texts a feature needs.
PER_CLASS, FEATURES, LEAST = 4000, 1024, 4
#: Weights of the counterfactual penalty and of the squared weights; words that a worker remembers.
FAIRNESS, DECAY, ENTRIES = 5.0, 2e-5, 400_000

# Identity terms that stand in for each other, by kind.
IDENTITIES = [
    "muslim christian jewish hindu buddhist sikh atheist catholic".split(),
    "muslims christians jews hindus buddhists sikhs atheists catholics".split(),
    "black white asian latino african european arab indigenous".split(),
    "women men".split(),
    "woman man".split(),
    "girls boys".split(),
    "gay lesbian bisexual straight transgender queer".split(),
    "immigrants refugees foreigners natives citizens".split(),
    "disabled deaf blind autistic".split(),
    "old young elderly".split(),
    "femmes hommes".split(),
    "frauen männer".split(),
    "mujeres hombres".split(),
    "musulmans chrétiens juifs".split(),
    "muslime christen juden".split(),
    "musulmanes cristianos judíos".split(),
]
SWAPS = {term: kind[(i + 1) % len(kind)] for kind in IDENTITIES for i, term in enumerate(kind)}

WORD = re.compile(r"\w+")


def word_features(word: str) -> list[int]:
    """Hashes of a word and of its beginnings of three to six characters."""
    parts = ["=" + word, *(f"{n}{word[:n]}" for n in range(3, 7) if len(word) > n)]
    return [xxhash.xxh3_64_intdigest(p) - (1 << 63) for p in parts]


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


class Model:
    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.of = dict(zip(features.tolist(), weights.tolist(), strict=True))
        self.bias = bias

    def known(self, word: str) -> tuple[int, ...]:
        return tuple(f for f in word_features(word) if f in self.of)


def _vectors(sample: DataFrame, features: np.ndarray) -> pd.DataFrame:
    """``toxic`` and the places of each text's features, before and after the swap."""
    spark = sample.sparkSession
    shared = spark.sparkContext.broadcast({f: i for i, f in enumerate(features.tolist())})

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = shared.value
        for part in parts:
            out = []
            for key, text, toxic in part[["place", "text", "toxic"]].itertuples(index=False):
                own = words(text)
                both = [
                    sorted({place[f] for w in some for f in word_features(w) if f in place})
                    for some in (own, {SWAPS.get(w, w) for w in own})
                ]
                out.append((key, toxic, *both))
            yield pd.DataFrame(out, columns=["place", "toxic", "x", "swapped"])

    found = sample.mapInPandas(find, "place long, toxic int, x array<int>, swapped array<int>").toPandas()
    return found.sort_values(["place", "toxic"], kind="stable")


def _dense(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float32)
    for i, places in enumerate(rows):
        out[i, places] = 1
    return out


def fit(
    x: np.ndarray,
    swapped: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray,
    fairness: float = FAIRNESS,
    decay: float = DECAY,
    steps: int = 400,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic loss plus ``fairness`` times the mean squared change."""
    weight = weight / weight.sum()
    moved = np.flatnonzero((x != swapped).any(1))
    change, share = x[moved] - swapped[moved], weight[moved]
    w, b = np.zeros(x.shape[1], np.float32), 0.0  # one type with ``x``: no copy of it at each step
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):  # Adam, all rows at each step
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        slope = (weight * (p - y)).astype(np.float32)
        g = x.T @ slope + decay * w
        if len(moved):
            g = g + fairness * 2 * (change.T @ (share * (change @ w)).astype(np.float32))
        g = np.r_[g, slope.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), b - step[-1]
    return w, float(b)


def learn(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, features: int = FEATURES, fairness: float = FAIRNESS
) -> Model:
    """Fit on the texts of ``docs (doc_id, text)`` that ``labels (doc_id, toxic)`` marks.

    Of each class the ids first by hash are taken, at most ``per_class``; an id with two labels is
    toxic, one with several texts gives one. Both classes weigh alike, so that a rare toxic word
    outweighs the bias.
    """
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    marks = marks.withColumn("place", F.xxhash64("doc_id"))
    # Each task keeps its first rows of a class, so that none gets all of them.
    clean, toxic = (
        marks.where(kind).orderBy("place", "doc_id").limit(per_class) for kind in ("toxic <= 0", "toxic > 0")
    )
    chosen = clean.union(toxic)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 ``per_class`` rows
    first = texts.groupBy("doc_id", "place", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = stored(first.select("place", "text", "toxic"), "toxicity-sample")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = (Counter(), Counter())
        for part in parts:
            for text, toxic in zip(part["text"], part["toxic"], strict=True):
                seen[int(toxic > 0)].update({f for w in words(text) for f in word_features(w)})
        keys = list(seen[0].keys() | seen[1].keys())
        yield pd.DataFrame({"f": keys, "a": [seen[0][k] for k in keys], "b": [seen[1][k] for k in keys]}, dtype="int64")

    counts = sample.mapInPandas(count, "f long, a long, b long").groupBy("f").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")
    )
    taken = sample.agg(
        F.sum((F.col("toxic") <= 0).cast("long")).alias("a"), F.sum((F.col("toxic") > 0).cast("long")).alias("b")
    ).first()
    n0, n1 = taken["a"] or 0, taken["b"] or 0
    if not n0 or not n1:
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((n1 + 0.5) / (n0 + 0.5))))
    p = (F.col("a") + F.col("b") + 1) / (n0 + n1 + 2)
    apart = F.abs(F.col("b") / n1 - F.col("a") / n0) / F.sqrt(p * (1 - p))
    best = counts.where(F.col("a") + F.col("b") >= LEAST).orderBy(F.desc(apart), "f").limit(features).select("f")
    kept = np.sort(best.toPandas()["f"].to_numpy(np.int64))
    found = _vectors(sample, kept)
    y = (found["toxic"].to_numpy() > 0).astype(float)
    weight = np.where(y > 0, 1 / n1, 1 / n0)
    w, b = fit(_dense(found["x"], len(kept)), _dense(found["swapped"], len(kept)), y, weight, fairness)
    return Model(kept, w, b)


def with_score(rows: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``rows`` and a double from 0 to 1: how likely the whole text is toxic. A null text is an empty one."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, memory = shared.value, {}
        for part in parts:
            out = []
            for value in part:
                features: set = set()
                for word in words(value):
                    known = memory.get(word)
                    if known is None:
                        known = memory[word] = model.known(word)
                    features.update(known)
                out.append(model.bias + sum(model.of[f] for f in sorted(features)))
                if len(memory) > ENTRIES:
                    memory.clear()
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, float), -30, 30))), dtype="float64")

    return rows.withColumn(name, judge(F.col(text)))


def judge(docs: DataFrame, labels: DataFrame, held: Column) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs (doc_id, text)``.

    Learns from labels of ids where ``held`` is false; without labels of both classes every score is
    the same. Repeated rows are judged alike. An empty table gives an empty one.
    """
    model = learn(docs, labels.where(~held))
    rows = with_score(docs.select("doc_id", "text", held.alias("held_out")), model)
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
