"""Quality classifier: a factorisation machine.

Features of a document: hashed words (log counts, unit length), statistics of
its structure, and the table's character count.  The score is

    sigmoid(b + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

so all pairwise interactions cost time linear in the features.

Training takes a bounded sample: at most ``SAMPLE`` labelled rows, those least
by a hash of the id, from the training fold alone (``crc32(doc_id) mod 5 <>
0``).  Their features reach the driver (bounded by ``SAMPLE x (WORDS +
STATISTICS)`` numbers), where mini-batch AdaGrad fits the weights.  Scoring
covers every whole text in one pass, with the weights broadcast (``(WORDS +
STATISTICS) x (FACTORS + 1)`` numbers).  Labels, language, source and id never
enter a score.

Defined cases: null text is empty, and an empty text gets the score of its
(zero) features; a null ``n_chars`` is the text's length; a null id counts as
held out; labels that are null are not used and of several labels of one id
the largest holds; of several texts of one id the one with the least digest
trains; without labelled rows of both kinds the score is the share
of label 1 (one half without any); repeated rows score alike; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, text_or_empty

WORDS = 1 << 14
STATISTICS = 16
FACTORS = 8
SAMPLE = 8000
EPOCHS = 6
BATCH = 64
RATE = 0.05
RIDGE = 1e-5
THRESHOLD = 0.3
FOLDS = 5
_CACHE = 300_000


class _Buckets(dict):
    """Word to bucket; emptied by the caller when large."""

    def __missing__(self, word: str) -> int:
        bucket = self[word] = zlib.crc32(word.encode("utf-8", "replace")) % WORDS
        return bucket


_BUCKETS = _Buckets()


def features(text: str, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: hashed words first, then the statistics in ``WORDS ...``."""
    if len(_BUCKETS) > _CACHE:
        _BUCKETS.clear()
    words = text.split()
    n, size = len(words), max(len(text), 1)
    if n:
        where = np.fromiter(map(_BUCKETS.__getitem__, words), np.int64, n)
        index, counts = np.unique(where, return_counts=True)
        values = np.log1p(counts)
        values = values / np.sqrt((values * values).sum())
    else:
        index, values = np.zeros(0, np.int64), np.zeros(0)
    lines = text.split("\n")
    upper, lower = sum(map(str.isupper, words)) / max(n, 1), sum(map(str.islower, words)) / max(n, 1)
    marks = [text.count(c) / max(n, 1) for c in "!|.,"]
    odd = sum(map(text.count, "$%&*#")) / max(n, 1)
    digits = sum(map(text.count, "0123456789")) / size
    once = len(set(lines)) / len(lines)
    statistics = np.array([
        np.log1p(size) / 10, np.log1p(n) / 10, size / max(n, 1) / 10, upper, lower, *np.minimum(marks, 3),
        min(odd, 3), digits * 5, len(set(words)) / max(n, 1), once, np.log1p(len(lines)) / 10,
        min(n / len(lines), 100) / 50, np.log1p(size if n_chars is None or n_chars != n_chars else max(n_chars, 0)) / 10])
    return np.append(index, WORDS + np.arange(STATISTICS)), np.append(values, statistics if n else 0 * statistics)


class FactorisationMachine:
    def __init__(self, seed: int = 7):
        size = WORDS + STATISTICS
        self.bias, self.linear = 0.0, np.zeros(size)
        self.factors = np.random.default_rng(seed).normal(0, 0.05, (size, FACTORS))

    def raw(self, index: np.ndarray, values: np.ndarray) -> float:
        own = self.factors[index] * values[:, None]
        return float(self.bias + self.linear[index] @ values
                     + 0.5 * ((own.sum(axis=0) ** 2).sum() - (own * own).sum()))

    def score(self, index: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(index, values), -35, 35))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> FactorisationMachine:
        """Mini-batch AdaGrad on the balanced logistic loss; a constant share if there is only one label."""
        share = (labels.sum() + 1) / (len(labels) + 2)
        if len(set(labels.tolist())) < 2:
            self.bias = float(np.log(share / (1 - share)))
            self.factors[:] = 0
            return self
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))       # both labels weigh alike
        rng, size = np.random.default_rng(seed), len(self.linear)
        sum_b, sum_w, sum_v = 1e-6, np.full(size, 1e-6), np.full((size, FACTORS), 1e-6)
        for _ in range(EPOCHS):
            shuffled = rng.permutation(len(rows))
            for at in range(0, len(rows), BATCH):
                take = shuffled[at:at + BATCH]
                index = np.concatenate([rows[i][0] for i in take])
                x = np.concatenate([rows[i][1] for i in take])
                of = np.repeat(np.arange(len(take)), [len(rows[i][0]) for i in take])
                starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))     # every row has the statistics
                v = self.factors[index]
                vx = v * x[:, None]
                sums = np.add.reduceat(vx, starts)
                raw = (self.bias + np.add.reduceat(self.linear[index] * x, starts)
                       + 0.5 * ((sums ** 2).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), starts)))
                error = (1 / (1 + np.exp(-np.clip(raw, -35, 35))) - labels[take]) * weight[take] / len(take)
                e = error[of] * x
                grad_b = error.sum()
                grad_w = np.bincount(index, e, size) + RIDGE * self.linear
                pull = e[:, None] * (sums[of] - vx)
                grad_v = np.stack([np.bincount(index, pull[:, f], size) for f in range(FACTORS)], axis=1) + RIDGE * self.factors
                sum_b += grad_b * grad_b
                sum_w += grad_w * grad_w
                sum_v += grad_v * grad_v
                self.bias -= RATE * grad_b / np.sqrt(sum_b)
                self.linear -= RATE * grad_w / np.sqrt(sum_w)
                self.factors -= RATE * grad_v / np.sqrt(sum_v)
        return self


def fold(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def training_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """``(text, n_chars, label)`` of at most ``limit`` labelled ids of the training fold."""
    picked = saved(labels.where(F.col("quality").isNotNull() & (fold() != 0))
                   .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("label"))
                   .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit), "quality-sample")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), _n_chars(docs))
    # one text an id, so that rows of a much repeated id cannot swell the sample
    text = F.min(F.struct(F.xxhash64("text").alias("digest"), "text", "n_chars")).alias("x")
    return (rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(text, F.max("label").alias("label"))
            .select("doc_id", "x.text", "x.n_chars", "label"))


def _n_chars(docs: DataFrame) -> Column:
    return (F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")).alias("n_chars")


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> FactorisationMachine:
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [features(t, c) for t, c in zip(pdf["text"], pdf["n_chars"], strict=True)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"],
                                "i": [i.astype("<i4").tobytes() for i, _ in rows],
                                "x": [x.astype("<f4").tobytes() for _, x in rows]})
    rows = (training_sample(docs, labels, limit)
            .mapInPandas(made, "doc_id long, label int, i binary, x binary").collect())   # bounded by ``limit``
    rows.sort(key=lambda r: (r["doc_id"], r["i"], r["x"]))       # the fit does not depend on the partitioning
    ready = [(np.frombuffer(r["i"], "<i4").astype(np.int64), np.frombuffer(r["x"], "<f4").astype(float)) for r in rows]
    return FactorisationMachine().fit(ready, np.array([r["label"] for r in rows], float))


def score(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, sizes in parts:
            yield pd.Series([shared.value.score(*features(t, c)) for t, c in zip(texts, sizes, strict=True)], dtype=float)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold() == 0).alias("held_out"),
                        text_or_empty().alias("text"), _n_chars(docs))
            .select("doc_id", "held_out", scored("text", "n_chars").alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def classify(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    return score(docs, train(docs, labels, limit))
