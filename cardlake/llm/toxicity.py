"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashed word unigrams, bigrams and
one-word-gap skip-grams of its whole lower-cased text.  Training goes over a
bounded sample of labelled rows (`MAX_POSITIVE`, `MAX_NEGATIVE`) with
per-coordinate learning rates; the L1 term leaves a few non-zero weights,
which are all that is sent to the executors (at most `DIM` of them).

Defined cases: a null or empty text has no feature and gets the score of the
bias; label rows with a null doc_id or toxic are ignored, repeated label rows
count as their largest label; documents with repeated ids are scored row by
row; with no labelled row every score is the prior 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import WordHash, hash_order, id_crc, mix, prepare, table

DIM = 1 << 20
MAX_POSITIVE = 800
MAX_NEGATIVE = 4800
WORD = re.compile(r"\w+")


def feature_ids(text: str | None, hashes: WordHash) -> np.ndarray:
    """Hashed features of a whole text, in order of appearance (with repeats)."""
    words = WORD.findall(text.lower()) if text else []
    if not words:
        return np.empty(0, np.int64)
    w = hashes.array(words)
    parts = [mix(w)]
    if len(w) > 1:
        parts.append(mix(w[:-1] * np.uint64(3) + w[1:] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)))
    if len(w) > 2:
        parts.append(mix(w[:-2] * np.uint64(5) + w[2:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(2)))
    return (np.concatenate(parts) & np.uint64(DIM - 1)).astype(np.int64)


@dataclass
class Ftrl:
    """Per-coordinate FTRL-proximal; coordinate DIM is the bias (no L1)."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0

    def fit(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, epochs: int) -> np.ndarray:
        z, n = np.zeros(DIM + 1), np.zeros(DIM + 1)
        l1 = np.full(DIM + 1, self.l1)
        l1[DIM] = 0.0
        for _ in range(epochs):
            for x, t, c in zip(rows, y, weight):
                zi, ni = z[x], n[x]
                w = self._weights(zi, ni, l1[x])
                p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
                g = c * (p - t)
                sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / self.alpha
                z[x] = zi + g - sigma * w
                n[x] = ni + g * g
        return self._weights(z, n, l1)

    def _weights(self, z: np.ndarray, n: np.ndarray, l1: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)


def training_sample(documents: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, text, toxic): at most MAX_POSITIVE + MAX_NEGATIVE labelled rows, in hash order."""
    lab = (labels.where("doc_id is not null and toxic is not null")
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    lab = documents.select("doc_id").where(learn).distinct().join(lab, "doc_id")
    pick = [lab.where(F.col("toxic") == t).orderBy(*hash_order()).limit(k)
            for t, k in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE))]
    ids = pick[0].unionByName(pick[1])
    return documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # bounded by the two limits


def train(documents: DataFrame, labels: DataFrame, learn: Column, epochs: int = 6) -> dict:
    """Compact weights {"index", "value", "bias"} of the bounded sample."""

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHash()
        for pdf in batches:
            feats = [np.unique(feature_ids(t, hashes)).astype(np.int32).tobytes() for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"].astype("int32"), "feats": feats})

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)) if (batches := list(batches)) else None
        if rows is None or not len(rows):
            return
        rows = rows.sort_values(["h", "doc_id", "toxic"], kind="stable")
        x = [np.append(np.frombuffer(b, np.int32).astype(np.int64), DIM) for b in rows["feats"]]
        w = Ftrl().fit(x, rows["toxic"].to_numpy(float), np.ones(len(rows)), epochs)
        kept = np.flatnonzero(w[:DIM])
        yield pd.DataFrame({"index": [kept.astype(np.int32).tobytes()], "value": [w[kept].tobytes()], "bias": [w[DIM]]})

    sample = training_sample(documents, labels, learn).mapInPandas(featurise, "doc_id long, toxic int, feats binary")
    one = sample.withColumn("h", F.xxhash64(F.lit(11), "doc_id")).repartition(1)  # the bounded sample only
    got = one.mapInPandas(fit, "index binary, value binary, bias double").collect()
    if not got:
        return {"index": b"", "value": b"", "bias": -35.0}
    return {"index": bytes(got[0]["index"]), "value": bytes(got[0]["value"]), "bias": got[0]["bias"]}


def score(documents: DataFrame, model: dict) -> DataFrame:
    """documents with a column `toxicity` (double), one narrow pass."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # at most DIM non-zero weights

    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        weights = np.zeros(DIM)
        weights[np.frombuffer(m["index"], np.int32)] = np.frombuffer(m["value"], np.float64)
        hashes = WordHash()

        def one(text):
            ids = feature_ids(text, hashes)
            ids = np.unique(ids[weights[ids] != 0])
            return 1.0 / (1.0 + np.exp(-np.clip(m["bias"] + weights[ids].sum(), -35, 35)))

        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")

    udf = F.pandas_udf(_annotate_series(toxicity), "double")
    return documents.withColumn("toxicity", udf(F.col("text")))


def _annotate_series(fn):
    fn.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return fn


THRESHOLD = 0.7


def op6_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = id_crc() % 3 == 1
    model = train(docs, table(spark, sf_dir, "labels"), ~held)
    return score(docs, model).select(
        "doc_id", held.alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
