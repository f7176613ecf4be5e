"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A text's tokens are runs of word characters and runs of punctuation. Token and token-pair hashes index a weight vector
of fixed length; a feature's value is ``SCALE`` times its share of the text's n-grams, so a score is a sparse dot product
that does not grow with length. Training reads a bounded sample of labelled rows: ``Settings.rows`` documents with the
smallest id hashes. It runs in ``Settings.shards`` tasks, each making its own weights in one order fixed by the id
hash; their mean is the model, at most ``2 ** bits`` numbers, so the driver and each task hold a bounded vector.

Nulls and odd cases: a NULL or empty text has no features and scores the intercept; NULL labels and labels of unknown
documents are not learnt from; of several labels of one id the mean counts (1 from one half up); repeated rows are
scored each; without any labelled row every score is 0.5. Extra columns are kept as they are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import plain_text

TOKEN = re.compile(r"\w+|[^\w\s]+")
SCALE = 32.0
PAIR = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier that makes a pair's hash depend on the order
MEMO = 1 << 17  # hashes of tokens a worker remembers


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    rows: int = 20_000  # labelled documents learnt from at most
    shards: int = 8
    passes: int = 2
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02


class Hasher:
    """Slots of a text's words and word pairs in the weight vector."""

    def __init__(self, bits: int) -> None:
        self.shift = np.uint64(64 - bits)
        self.memo: dict[str, int] = {}

    def slots(self, text: str) -> np.ndarray:
        memo, tokens = self.memo, TOKEN.findall(text)
        if len(memo) > MEMO:
            memo.clear()
        codes = []
        for token in tokens:
            code = memo.get(token)
            if code is None:
                code = memo[token] = xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
            codes.append(code)
        one = np.array(codes, dtype=np.uint64)
        two = (one[:-1] * PAIR) ^ one[1:]
        two *= PAIR
        two[one[:-1] == one[1:]] = PAIR  # a word said twice is the same pair whatever the word
        return (np.concatenate([one, two]) >> self.shift).astype(np.int64)


def features(text: str, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    slots = hasher.slots(text)
    index, count = np.unique(slots, return_counts=True)
    return index, count * (SCALE / max(1, len(slots)))


def follow_leader(examples: list[tuple[np.ndarray, np.ndarray, int]], s: Settings) -> np.ndarray:
    """Weights after ``passes`` over the examples; the last weight is the intercept, which is not regularised."""
    size = (1 << s.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(zi: np.ndarray, ni: np.ndarray, l1: float, l2: float) -> np.ndarray:
        return -np.sign(zi) * np.maximum(np.abs(zi) - l1, 0) / ((s.beta + np.sqrt(ni)) / s.alpha + l2)

    def update(at, g, w) -> None:
        step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha
        z[at] += g - step * w
        n[at] += g * g

    for _ in range(s.passes):
        for index, value, label in examples:
            w = weights(z[index], n[index], s.l1, s.l2)
            b = weights(z[-1:], n[-1:], 0.0, 0.0)[0]
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w @ value) + b))))
            update(index, (p - label) * value, w)
            update(-1, p - label, b)
    out = weights(z, n, s.l1, s.l2)
    out[-1] = weights(z[-1:], n[-1:], 0.0, 0.0)[0]
    return out


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """The weight vector learnt from ``docs (doc_id, text)`` and ``labels (doc_id, label 0/1)``."""
    sample = (
        labels.where("label IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.rows)
    )
    # At most settings.rows ids and labels: a bounded broadcast, so the documents are not shuffled.
    rows = docs.select("doc_id", plain_text().alias("text")).join(F.broadcast(sample), "doc_id")

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(settings.bits)
        for frame in frames:
            found = [features(text, hasher) for text in frame.text]
            yield pd.DataFrame({
                "order": frame.order, "label": frame.label,
                "index": [i.astype(np.int32) for i, _ in found], "value": [v for _, v in found],
            })

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("order", kind="stable")
        weights = follow_leader(list(zip(frame["index"], frame["value"], frame["label"])), settings)
        slot = np.flatnonzero(weights)
        return pd.DataFrame({"slot": slot, "weight": weights[slot]})

    learnt = (
        rows.select(F.xxhash64("doc_id").alias("order"), "label", "text")
        .mapInPandas(extract, "order long, label int, index array<int>, value array<double>")
        .groupBy(F.pmod(F.hash("order"), F.lit(settings.shards)).alias("shard"))
        .applyInPandas(learn, "slot long, weight double")
    )
    # A slot missing from a shard has weight zero there; shards without rows are not counted.
    shards = rows.select(F.pmod(F.hash(F.xxhash64("doc_id")), F.lit(settings.shards)).alias("s")).distinct().count()
    model = np.zeros((1 << settings.bits) + 1)
    for slot, weight in learnt.groupBy("slot").agg(F.sum("weight").alias("w")).collect():
        model[slot] = weight / shards
    return model


def score(docs: DataFrame, model: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with a column ``score``: the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, hasher = shared.value, Hasher(settings.bits)
        for texts in batches:
            raw = np.empty(len(texts))
            for k, text in enumerate(texts):
                slots = hasher.slots(text)
                raw[k] = weights[-1] + weights[slots].sum() * (SCALE / max(1, len(slots)))
            yield pd.Series(1 / (1 + np.exp(-np.clip(raw, -35, 35))))

    return docs.withColumn("score", probability(plain_text()))
