"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import freeze
from .text import key_text, keyed_back

#: Lengths of n-grams in bytes of the lower-cased text, and the hash buckets they share.
LENGTHS = (4, 5, 6)
BUCKETS_LOG2 = 20
#: The classifier is fitted on at most so many labelled rows of each class, those with the smallest hashes of their id.
ROWS_PER_CLASS = 8_000
#: It sees so many n-grams: those whose log-count ratio is the most certain.
FEATURES = 8_192
SMOOTHING = 1.0
PENALTY = 1e-3
ROUNDS = 60

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PRIME = np.uint32(0x01000193)


def grams(body: bytes) -> Iterator[np.ndarray]:
    """The bucket of every n-gram of a text, for each length; a text is padded by a space at either end."""
    b = _LOWER[np.frombuffer(b" " + body + b" ", dtype=np.uint8)].astype(np.uint32)
    h = np.full(len(b), 2166136261, dtype=np.uint32)
    for n in range(max(LENGTHS)):
        if len(b) <= n:
            return
        h = (h[:len(b) - n] ^ b[n:]) * _PRIME
        if n + 1 in LENGTHS:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            yield (mixed ^ np.uint32(n)) >> np.uint32(32 - BUCKETS_LOG2)


def _bytes(text) -> bytes:
    return text.encode() if isinstance(text, str) else b""


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int = ROWS_PER_CLASS) -> DataFrame:
    """``text, label`` of at most ``rows`` labelled documents per class; the ids are chosen first and their number bounds the broadcast."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_id")).agg(F.max(label).cast("int").alias("label"))
    chosen = None
    for c in (0, 1):
        part = known.where(F.col("label") == c).orderBy(F.xxhash64("_id"), "_id").limit(rows)
        chosen = part if chosen is None else chosen.union(part)
    chosen = freeze(chosen, "chosen")
    return docs.join(F.broadcast(chosen), docs[key] == F.col("_id")).select(F.col(text).alias("text"), "label")


def fit(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Weights per bucket and the intercept, from a bounded table of ``text, label``.

    Counts of rows with an n-gram, per class, are sums over tasks. The log-count ratio r of an n-gram compares its share
    in the two classes; logistic regression is then fitted by Spark on the features r (n-gram present) or 0, with the
    classes balanced. Without both classes the weights are 0 and the intercept is the log odds of the smoothed share.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector, VectorUDT

    rows = freeze(rows, "training")
    of = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    size = 1 << BUCKETS_LOG2
    if len(of) < 2:
        share = (of.get(1, 0) + SMOOTHING) / (sum(of.values()) + 2 * SMOOTHING)
        return np.zeros(size, np.float32), float(np.log(share / (1 - share)))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, size), np.int32)
        for f in frames:
            for t, c in zip(f["text"], f["label"]):
                for n in (np.unique(np.concatenate([*grams(_bytes(t)), np.zeros(0, np.uint32)])),):
                    seen[c, n.astype(np.int64)] += 1
        at = np.flatnonzero(seen.sum(axis=0))
        yield pd.DataFrame({"bucket": at, "n0": seen[0, at], "n1": seen[1, at]})

    counts = (rows.mapInPandas(count, "bucket int, n0 bigint, n1 bigint").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    p1, p0 = (F.col("n1") + SMOOTHING) / (of[1] + 2 * SMOOTHING), (F.col("n0") + SMOOTHING) / (of[0] + 2 * SMOOTHING)
    spread = F.sqrt(1 / (F.col("n1") + SMOOTHING) + 1 / (F.col("n0") + SMOOTHING))
    best = (counts.withColumn("r", F.log(p1 / p0)).withColumn("z", F.abs("r") / spread)
            .orderBy(F.desc("z"), "bucket").limit(FEATURES).select("bucket", "r").collect())  # at most FEATURES rows
    bucket = np.array([x.bucket for x in best])
    order = np.argsort(bucket)
    bucket, ratio = bucket[order], np.array([x.r for x in best])[order]
    place = np.full(size, -1, np.int32)
    place[bucket] = np.arange(len(bucket))

    @F.udf(VectorUDT())
    def features(text):
        at = np.unique(np.concatenate([place[g] for g in grams(_bytes(text))] or [np.zeros(0, np.int32)]))
        at = at[at >= 0]
        return SparseVector(len(bucket), at.tolist(), ratio[at].tolist())

    weight = F.when(F.col("label") == 1, 0.5 / of[1]).otherwise(0.5 / of[0]) * sum(of.values())
    train = freeze(rows.select(features("text").alias("features"), F.col("label").cast("double").alias("label"), weight.alias("weight")), "features").cache()
    model = LogisticRegression(maxIter=ROUNDS, regParam=PENALTY, standardization=False, weightCol="weight").fit(train)
    train.unpersist()
    weights = np.zeros(size, np.float32)
    weights[bucket] = model.coefficients.toArray() * ratio
    return weights, float(model.intercept)


def score(docs: DataFrame, key: str, weights: np.ndarray, intercept: float, text: str = "text") -> DataFrame:
    """``key, score`` (0 to 1) for every whole text; NULL and empty texts are scored by what little they hold.

    An n-gram counts once however often it occurs, so a long text is not toxic for its length. Each row is scored by
    itself, in one pass without a shuffle; the weights have a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast((weights, intercept))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, b = shared.value
        used = w != 0
        for f in frames:
            out = np.empty(len(f))
            for k, t in enumerate(f["_text"]):
                hits = [g[used[g]] for g in grams(_bytes(t))]
                out[k] = b + (w[np.unique(np.concatenate(hits))].sum(dtype=np.float64) if hits else 0.0)
            yield pd.DataFrame({key: f[key], "score": 1 / (1 + np.exp(-np.clip(out, -500, 500)))})

    return keyed_back(docs.select(key_text(key), F.col(text).alias("_text")).mapInPandas(run, f"`{key}` string, score double"), docs, key)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5) -> DataFrame:
    """``key, held_out, score, predicted`` for every document; labels are learned only from rows that are not held out.

    A row is held out if the CRC32 of its key as text is divisible by ``folds``. Labels that are not 0 or 1 are
    ignored, and of several labels of a key the largest counts. NULL keys have no labels and are not held out.
    """
    held = lambda c: F.crc32(c.cast("string").cast("binary")) % folds == 0
    weights, intercept = fit(sample(docs, labels.where(~held(F.col(key))), key, text, label))
    s = score(docs, key, weights, intercept, text)
    return s.select(key, F.coalesce(held(F.col(key)), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
