"""Language identification with error-correcting output codes.

Every language has a codeword. For each bit a binary classifier on character n-gram shares predicts
on which side a text stands. Decoding is loss-weighted: a language's distance is the logistic loss
of all bits against its codeword, weighted by how well each classifier knew that language; the
nearest codeword wins, and a close second flags the text as ambiguous.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of hashed n-grams; rows of a language, and of all, that a fit takes; bits beyond 7 languages.
BUCKETS, PER_LANGUAGE, IN_ALL, LONG_CODE = 4096, 400, 6000, 31
#: A text is ambiguous if its second language has at least this share of the first one's weight.
CLOSE = 0.5

MAYBE_LETTER = re.compile(r"[^\W\d_]")
#: ASCII characters that are no letters all count as a blank.
PLAIN = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    # What is no digit but alphanumeric may still be a number sign, such as a fraction.
    return any(m[0].isalpha() for m in MAYBE_LETTER.finditer(text or ""))


def shares(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte 2- and 3-grams in a whole text, of unit length."""
    raw = (" " + text.lower() + " ").encode().translate(PLAIN)
    out = np.zeros(BUCKETS)
    for at in range(0, len(raw), 1 << 20):  # parts overlap by two bytes: each n-gram counts once
        b = np.frombuffer(raw[at : at + (1 << 20) + 2], np.uint8).astype(np.uint32)
        two = b[:-1] | b[1:] << np.uint32(8)
        three = two[:-1] | b[2:] << np.uint32(16) | np.uint32(1 << 24)
        if at + (1 << 20) + 2 <= len(raw):
            two = two[:-1]
        for gram in (two, three):
            out += np.bincount((gram * np.uint32(2654435761)) >> np.uint32(20), minlength=BUCKETS)
    out = np.sqrt(out)
    return (out / max(1e-12, np.sqrt((out * out).sum()))).astype(np.float32)


def codewords(count: int) -> np.ndarray:
    """A +1/-1 matrix with a row for each class: all columns for a few classes, else random far ones."""
    if count <= 1:
        return np.ones((count, 1), np.int8)
    if count <= 7:
        columns = [(1, *rest) for rest in itertools.product((1, -1), repeat=count - 1) if -1 in rest]
        return np.array(columns, np.int8).T
    best, far, draw = None, -1, np.random.default_rng(7)
    for _ in range(200):
        code = draw.choice(np.array([-1, 1], np.int8), (count, LONG_CODE))
        apart = ((code[:, None, :] != code[None, :, :]).sum(2) + LONG_CODE * np.eye(count, dtype=int)).min()
        if apart > far and (abs(code.sum(0)) < count).all():
            best, far = code, apart
    return best


class Codes:
    """The classifiers and what decoding needs."""

    def __init__(self, x: np.ndarray, labels: list[str], steps: int = 300, decay: float = 1e-4):
        self.names = sorted(set(labels))
        y = np.array([self.names.index(v) for v in labels])
        self.code = codewords(len(self.names))
        bits, classes = self.code.shape[1], len(self.names)
        share = np.bincount(y, minlength=classes)[y]
        weight = (1.0 / share / classes)[:, None].astype(np.float32)  # every language counts alike
        goal = self.code[y].astype(np.float32)
        w, b = np.zeros((x.shape[1], bits), np.float32), np.zeros(bits, np.float32)
        mw, vw = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, steps + 1):  # Adam on the logistic loss
            margin = goal * (x @ w + b)
            slope = -goal * weight / (1 + np.exp(np.clip(margin, -30, 30)))
            g = x.T @ slope + decay * w
            mw, vw = 0.9 * mw + 0.1 * g, 0.999 * vw + 0.001 * g * g
            w -= 0.3 * (mw / (1 - 0.9**t)) / (np.sqrt(vw / (1 - 0.999**t)) + 1e-8)
            b -= 2.0 * slope.sum(0)
        self.w, self.b = w.astype(np.float32), b
        right = (goal * (x @ w + b)) > 0
        # How often each bit was right for each language, as weights that sum to one.
        known = np.array([right[y == c].mean(0) for c in range(classes)]) + 1e-6
        self.weight = known / known.sum(1, keepdims=True)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(class, share of the weight, share of the second)`` for each row of features."""
        out = x @ self.w + self.b
        loss = np.logaddexp(0, -self.code[None, :, :] * out[:, None, :])
        distance = (loss * self.weight[None, :, :]).sum(2) * self.code.shape[1]
        p = np.exp(distance.min(1, keepdims=True) - distance)
        p /= p.sum(1, keepdims=True)
        order = np.argsort(-p, axis=1, kind="stable")
        at = np.arange(len(p))
        second = p[at, order[:, 1]] if p.shape[1] > 1 else np.zeros(len(p))
        return order[:, 0], p[at, order[:, 0]], second


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE, in_all: int = IN_ALL) -> Codes | None:
    """Fit on ``labelled (doc_id, text, lang)``: of each language the rows first by a hash of id and text,
    at most ``per_language`` and ``in_all`` together. None if there are none."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    languages = rows.agg(F.count_distinct("lang").alias("n")).first()["n"]
    if not languages:
        return None
    most = max(1, min(per_language, in_all // languages))
    first = Window.partitionBy("lang").orderBy("place", "doc_id")
    # Ranks are found on keys alone; the few texts are joined afterwards.
    keys = rows.select("doc_id", "lang", F.xxhash64("doc_id", "text").alias("place")).distinct()
    chosen = keys.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most).select("lang", "place")
    texts = rows.withColumn("place", F.xxhash64("doc_id", "text"))
    texts = texts.join(F.broadcast(chosen), ["lang", "place"])  # at most ``in_all`` rows

    def vectors(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame(
                {"lang": part["lang"], "place": part["place"], "x": [shares(t).tobytes() for t in part["text"]]}
            )

    found = texts.select("lang", "place", "text").mapInPandas(vectors, "lang string, place long, x binary")
    found = found.dropDuplicates(["lang", "place"]).toPandas().sort_values(["lang", "place"])
    return Codes(np.array([np.frombuffer(v, np.float32) for v in found["x"]]), found["lang"].tolist())


def identify(docs: DataFrame, held: Column, lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, second, ambiguous`` for each row of ``docs``.

    Learns from rows where ``held`` is false and neither text nor language is null. A null text, one
    without letters, or any text if there is nothing to learn from is ``und`` with score 0. Repeated
    rows are judged alike; texts are read whole. An empty table gives an empty one.
    """
    rows = docs.select("doc_id", "text", F.col(lang).alias("lang"))
    model = learn(rows.where(~held))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, second double, ambiguous boolean")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codes = shared.value
        for part in parts:
            out = pd.DataFrame({"lang_pred": "und", "score": 0.0, "second": 0.0, "ambiguous": True}, index=part.index)
            texts = [(i, t) for i, t in enumerate(part) if codes is not None and has_letter(t)]
            for at in range(0, len(texts), 512):
                some = texts[at : at + 512]
                best, score, second = codes.decode(np.array([shares(t) for _, t in some]))
                places = [i for i, _ in some]
                out.iloc[places, 0] = [codes.names[c] for c in best]
                out.iloc[places, 1], out.iloc[places, 2] = score, second
                out.iloc[places, 3] = second >= CLOSE * score
            yield out

    return rows.select("doc_id", held.alias("held_out"), judge("text").alias("x")).select("doc_id", "held_out", "x.*")
